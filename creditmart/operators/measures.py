"""The measure family every summary shares: counts, rates and rounded means.

All return aggregate expressions as text, named where they are a report column.
"""

from __future__ import annotations

from creditmart.functions import numbers as num

N = "count(1)"
N_APPROVED = "count_if(label = 1)"
N_REJECTED = "count_if(label = 0)"
RATE = num.ratio(N_APPROVED, N)

APPROVAL_RATE = f"{RATE} AS approval_rate"
CHARGED_OFF = (
    "sum(is_charged_off) AS charged_off_cnt",
    f"{num.ratio('sum(is_charged_off)', N)} AS charged_off_rate",
)


def average(column: str, digits: int, name: str | None = None) -> str:
    return f"{num.mean(column, digits)} AS {name or f'avg_{column}'}"


# Digits each figure is reported with.
AVG_AMOUNT = average("loan_amnt", 2)
AVG_DTI = average("dti", 4)
AVG_RATE = average("int_rate", 4)
AVG_INCOME = average("annual_inc", 2)
AVG_EMPLOYMENT = average("emp_length", 2)
