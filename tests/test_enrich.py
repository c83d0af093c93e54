from __future__ import annotations

import random

import pytest

from threadline.operators import enrich, report


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def best(name, tables, max_edits, floor):
    near = [(levenshtein(name, t), -len(t), t) for t in tables]
    near = sorted(n for n in near if n[0] <= max_edits)
    if not near:
        return None, None
    edits, _, table = near[0]
    score = 1 - edits / max(len(name), len(table), 1)
    return (table, score) if score >= floor else (None, None)


def words(rng, n, letters, low, high):
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(n)})


def numbered(rng, n):
    return sorted({f"{rng.choice(['raw.cust_', 'stg.s', 'mart.mm_', 'lib.t_'])}{rng.randrange(4000)}" for _ in range(n)})


@pytest.mark.parametrize("kind", ["dense", "numbered", "short"])
@pytest.mark.parametrize("max_edits", [1, 2])
def test_match_against_brute_force(spark, kind, max_edits):
    rng = random.Random(kind)
    if kind == "dense":
        names, tables = words(rng, 60, "ab.", 4, 9), words(rng, 40, "ab.", 4, 9)
    elif kind == "short":
        names, tables = words(rng, 30, "abc", 1, 3), words(rng, 12, "abc", 1, 3)
    else:
        names, tables = numbered(rng, 150), numbered(rng, 60) + ["martt.mm_1", "raw.cus_77"]
    floor = 0.5
    found = enrich.match_catalog(
        spark.createDataFrame([(n,) for n in names], "dataset_name string"),
        spark.createDataFrame([(t,) for t in tables], "table_name string"),
        max_edits,
        floor,
    ).collect()
    assert len(found) == len(names)
    for r in found:
        table, score = best(r["dataset_name"], tables, max_edits, floor)
        assert r["unity_catalog_match"] == table, r
        assert r["match_confidence"] == (None if score is None else pytest.approx(score))


def test_match_without_edits_or_tables(spark):
    names = spark.createDataFrame([("a",), ("b",)], "dataset_name string")
    tables = spark.createDataFrame([("a",), ("bb",)], "table_name string")
    found = {r[0]: r[1] for r in enrich.match_catalog(names, tables, 0).collect()}
    assert found == {"a": "a", "b": None}
    none = enrich.match_catalog(names, tables.limit(0)).collect()
    assert {r[0]: r[1] for r in none} == {"a": None, "b": None}
    with pytest.raises(ValueError):
        enrich.match_catalog(names, tables, 3)


def best_ratio(name, tables, floor):
    near = sorted((levenshtein(name, t) / max(len(name), len(t), 1), t) for t in tables)
    if not near or 1 - near[0][0] < floor:
        return None, None
    return near[0][1], 1 - near[0][0]


def edited(rng, word, edits, letters="abcdefgh_0123456789"):
    for _ in range(edits):
        i = rng.randrange(len(word) + 1)
        kind = rng.randrange(3)
        word = word[:i] + (rng.choice(letters) if kind else "") + word[i + (kind != 1):]
    return word


@pytest.mark.parametrize("floor", [0.5, 0.7])
def test_match_at_any_number_of_edits(spark, floor):
    rng = random.Random(str(floor))
    tables = words(rng, 40, "abcdefgh_01", 2, 30) + numbered(rng, 20)
    names = [edited(rng, t, rng.randint(0, 9)) for t in tables for _ in range(2)]
    names += words(rng, 20, "ab1", 0, 6)
    # The best ratio is not the fewest edits: 3 of 10 against 4 of 14.
    names.append("qrstuvwxyz")
    tables += ["qrs+++wxyz", "q-r-stuvw-xy-z"]
    names, tables = sorted(set(names)), sorted(set(tables))
    found = enrich.match_catalog(
        spark.createDataFrame([(n,) for n in names], "dataset_name string"),
        spark.createDataFrame([(t,) for t in tables], "table_name string"),
        min_confidence=floor,
    ).collect()
    assert sorted(r["dataset_name"] for r in found) == names
    for r in found:
        table, score = best_ratio(r["dataset_name"], tables, floor)
        assert r["unity_catalog_match"] == table, r
        assert r["match_confidence"] == (None if score is None else pytest.approx(score))


def test_match_beyond_two_edits(spark, salted):
    name, table = "warehouse.customer_transactions", "warehouse.customer_transact"
    found = enrich.match_catalog(
        spark.createDataFrame([(name,)], "dataset_name string"),
        spark.createDataFrame([(table,), ("warehouse.customer_trans",), ("other",)], "table_name string"),
    ).collect()
    assert [(r[0], r[1], round(r[2], 2)) for r in found] == [(name, table, 0.87)]


RULES = [
    (2, "raw.%", "Sales", "Reference", "Internal"),
    (1, "raw.cust%", "Sales", "Master", "PII"),
    (1, "raw.cu%", "HR", "Master", "PII"),
    (3, "%_tmp", "None", "Transactional", "Internal"),
    (3, "m_rt.x", "Finance", "Transactional", "Internal"),
]


def classified(spark):
    names = ["raw.cust_1", "raw.x", "a.b_tmp", "mart.x", "other"]
    rows = enrich.classify_datasets(
        spark.createDataFrame([(n,) for n in names], "dataset_name string"),
        spark.createDataFrame(
            RULES, "priority int, pattern string, business_domain string, data_category string, sensitivity_level string"
        ),
    )
    return rows


WANT = {"raw.cust_1": "HR", "raw.x": "Sales", "a.b_tmp": "None", "mart.x": "Finance", "other": None}


def test_rules(spark):
    rows = classified(spark).collect()
    assert {r["dataset_name"]: r["business_domain"] for r in rows} == WANT and len(rows) == len(WANT)


def test_rules_with_hot_heads_spread(spark, salted):
    assert {r["dataset_name"]: r["business_domain"] for r in classified(spark).collect()} == WANT


def test_domain_breakdown(spark):
    totals = {(r[0], r[1], r[2]): r[3] for r in report.domain_breakdown(classified(spark)).collect()}
    assert totals[(None, None, 3)] == 5
    assert totals[("Sales", None, 1)] == 1
