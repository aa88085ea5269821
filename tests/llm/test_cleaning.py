"""op1, op4, op6 and op7 against brute force, on tables with every awkward row."""

from __future__ import annotations

import hashlib
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import cases  # noqa: E402

from creditmart.llm import exact_dedup, ngram_join, quality_rules, suffix_dedup  # noqa: E402
from creditmart.llm.components import connected_components  # noqa: E402


def got(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def test_cover_is_perfect():
    differences = [(a - b) % suffix_dedup.V for a in suffix_dedup.COVER for b in suffix_dedup.COVER if a != b]
    assert sorted(differences) == list(range(1, suffix_dedup.V))


@pytest.mark.parametrize("block_rows,bucket_names", [(1024, 1 << 21), (3, 100)])
def test_suffix_dedup(spark, block_rows, bucket_names):
    rows = cases.texts()
    found = suffix_dedup.remove_repeats(cases.table(spark, rows), block_rows=block_rows, bucket_names=bucket_names)
    assert got(found) == sorted(cases.removed(rows), key=repr)


def test_suffix_dedup_returns_the_bytes(spark):
    rows = cases.texts()
    found = suffix_dedup.remove_repeats(cases.table(spark, rows), with_text=True).collect()
    assert len(found) == len(rows)
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in found)


def test_exact_groups(spark):
    rows = cases.texts()
    best: dict = {}
    for i, t, _ in rows:
        best.setdefault(cases.squeezed(t), []).append((-len(t or ""), i is None, i))
    want = [
        (i, min(best[s])[2], len(best[s]), i == min(best[s])[2], hashlib.sha256(s.encode()).hexdigest()) for i, t, _ in rows for s in [cases.squeezed(t)]
    ]
    assert got(exact_dedup.duplicate_groups(cases.table(spark, rows))) == sorted(want, key=repr)


def test_exact_dedup_keeps_one_row_of_each_group(spark):
    rows = cases.texts()
    docs = cases.table(spark, rows)
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    texts = [cases.squeezed(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({cases.squeezed(t) for _, t, _ in rows})
    assert {r["doc_id"] for r in kept.collect()} >= {3, 4, 12, 8}


def test_exact_dedup_is_right_with_a_full_filter(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "filter_bits", lambda rows: 8)
    rows = cases.texts()
    assert exact_dedup.exact_dedup(cases.table(spark, rows)).count() == len({cases.squeezed(t) for _, t, _ in rows})


def test_bands_reach_the_recall():
    bands, per_band = ngram_join.choose_bands(0.8, 0.9999, 128)
    assert 1 - (1 - 0.8**per_band) ** bands >= 0.9999 and bands * per_band <= 128
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.01, 0.999999, 4)


@pytest.mark.parametrize("block_rows", [256, 2])
def test_ngram_join(spark, monkeypatch, block_rows):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 1 << 20 if block_rows == 256 else 300)
    rows = [r for r in cases.texts() if r[0] is not None]
    rows += [(200 + k, " ".join(w if j != 7 * k else "new" for j, w in enumerate(cases.prose(120, 3).split())), "a") for k in range(1, 9)]
    links, groups = cases.shingle_links(rows)
    found = ngram_join.ngram_join(cases.table(spark, rows))
    want = [(i, min(rows[y][0] for y in groups[x]), links[x]) for x, (i, _, _) in enumerate(rows)]
    assert got(found, "doc_id", "class_id", "n_links") == sorted(want, key=repr)


def test_near_duplicates_leave_one_of_each_group(spark):
    rows = cases.texts()
    _, groups = cases.shingle_links(rows)
    kept = ngram_join.drop_near_duplicates(cases.table(spark, rows))
    assert kept.columns == cases.table(spark, rows).columns
    assert kept.count() == len({min(g) for g in groups.values()})
    best = {min(((rows[y][0] is None, rows[y][0] or 0) for y in g)) for g in groups.values()}
    assert {(r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()} == best


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    found = dict(got(connected_components(spark.createDataFrame(edges, "a long, b long"))))
    assert set(found[k] for k in range(41)) == {0} and set(found[k] for k in range(100, 140)) == {100}


def test_quality_measures(spark):
    rows = cases.texts()
    found = quality_rules.quality_rules(cases.table(spark, rows), cases.labels(spark))
    want = []
    for i, t, _ in rows:
        w, lines = cases.words_of(t), [x for x in (t or "").split("\n") if cases.squeezed(x)]
        again = cases.repeat_words(w)
        failed = len(w) < 10 or 100 * again > 20 * len(w)
        want.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), again, failed))
    assert got(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(want, key=repr)
    assert found.filter("base_failed AND kept").count() == 0


def test_rules_find_a_planted_threshold(spark):
    pure = [(i, cases.prose(40 + i % 30, i), "a") for i in range(300)]
    rows = [(i, " ".join(w + "##" for w in t.split()) if i % 4 == 0 else t, s) for i, t, s in pure]
    marks = cases.labels(spark, [(i, int(i % 4 > 0), 0) for i in range(300)])
    measured = quality_rules.measures(cases.table(spark, rows))
    rules = quality_rules.learn(measured, marks)
    assert rules and rules[0][0].feature == "symbol_share" and not rules[0][0].below
    assert "CASE WHEN" in str(quality_rules.verdict(rules))
    kept = {r["doc_id"] for r in quality_rules.judge(measured, rules).filter("kept").collect()}
    assert kept == {i for i in range(300) if i % 4 > 0}


def test_without_labels_the_base_rules_decide(spark):
    found = quality_rules.quality_rules(cases.table(spark, cases.texts()), cases.labels(spark, []))
    assert found.filter("kept = base_failed").count() == 0


def test_empty_tables(spark):
    none = cases.table(spark, [])
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert exact_dedup.duplicate_groups(none).count() == 0
    assert exact_dedup.exact_dedup(none).count() == 0
    assert ngram_join.ngram_join(none).count() == 0
    assert ngram_join.drop_near_duplicates(none).count() == 0
    assert quality_rules.quality_rules(none, cases.labels(spark, [])).count() == 0


def test_rows_without_ids_give_one_set_a_class(spark, monkeypatch):
    """Copies that share an id, or have none, do not multiply what is compared; ids are part of the answer all the same."""
    from creditmart.llm import ngram_join

    base = cases.prose(60, 1)
    near = base.split()
    near[30] = "changed"
    rows = [(None, base, "a")] * 150 + [(7, base, "a")] * 50 + [(None, " ".join(near), "b"), (9, cases.prose(60, 2), "a"), (None, None, None), (None, "", None)]
    seen = []
    inner = ngram_join._sets
    monkeypatch.setattr(ngram_join, "_sets", lambda *a: seen.append(inner(*a)) or seen[-1])
    found = ngram_join.ngram_join(cases.table(spark, rows)).collect()
    assert seen[0].count() == 2
    links, groups = cases.shingle_links(rows)
    want = sorted((repr(rows[x][0]), links[x]) for x in range(len(rows)))
    assert sorted((repr(r["doc_id"]), r["n_links"]) for r in found) == want
    assert {r["class_id"] for r in found if r["copies"] == 200} == {7}
