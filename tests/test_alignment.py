"""Alignment of column lists."""

import random

from tidemark.operators.alignment import alignment_report, schema_alignment
from tidemark.operators.schema import CATALOGUE_SCHEMA, column_catalogue, schema_drift_report, schema_diff_import


def longest(source, target):
    """Length of the longest common subsequence, by the textbook table."""
    best = [[0] * (len(target) + 1) for _ in range(len(source) + 1)]
    for i, s in enumerate(source, 1):
        for j, t in enumerate(target, 1):
            best[i][j] = best[i - 1][j - 1] + 1 if s == t else max(best[i - 1][j], best[i][j - 1])
    return best[-1][-1]


def test_equals_the_longest_common_subsequence(spark):
    rng = random.Random(4)
    sides = {}
    for k in range(60):
        names = [f"c{n}" for n in range(rng.randint(0, 12))]
        sides[f"t{k}"] = rng.sample(names, rng.randint(0, len(names))), rng.sample(names, rng.randint(0, len(names)))
    frames = [
        spark.createDataFrame(
            [(t, i, n.upper() if at else n, "int") for t, pair in sides.items() for i, n in enumerate(pair[at], 1)], CATALOGUE_SCHEMA
        )
        for at in (0, 1)
    ]
    found = {}
    for r in schema_alignment(*frames).collect():
        found.setdefault(r["table_name"], {}).setdefault(r["change"], []).append(r)
    for table, (source, target) in sides.items():
        rows = found.get(table, {})
        kept = sorted(rows.get("kept", []), key=lambda r: r["source_ordinal"])
        assert len(kept) == longest(source, target)
        assert [r["target_ordinal"] for r in kept] == sorted(r["target_ordinal"] for r in kept)
        assert {r["name"].lower() for r in rows.get("inserted", [])} == set(source) - set(target)
        assert {r["name"].lower() for r in rows.get("removed", [])} == set(target) - set(source)
        assert len(kept) + len(rows.get("moved", [])) == len(set(source) & set(target))


def test_one_inserted_column_is_one_change(spark):
    """The comparison by position flags all columns behind it; both are there."""
    old = [(f"c{k}", "int") for k in range(6)]
    new = [*old[:2], ("Extra", "int"), *[(n.upper(), t) for n, t in old[2:]]]
    source, target = column_catalogue(spark, {"t": new, "same": old}), column_catalogue(spark, {"t": old, "same": old})
    assert [tuple(r) for r in alignment_report(schema_alignment(source, target)).collect()] == [("t", 1, 0, 0)]
    assert schema_drift_report(schema_diff_import(source, target)).first()["drifted"] == 4
    assert schema_alignment(source.limit(0), target.limit(0)).collect() == []
