import duckdb

from tidemark.llm.licenses import TEMPLATES, anchor_words, license_sql, scan_licenses, size_bounds, template_bigrams

MIT = " ".join(TEMPLATES["MIT"].split())


def brute(text, threshold=0.8):
    units = [(k, line) for k, line in enumerate(text.split("\n"))] + ([(-1, text)] if "\n" in text else [])
    for line, unit in units:
        pairs = set(template_bigrams(unit))
        best = None
        for name, body in sorted(TEMPLATES.items()):
            other = set(template_bigrams(body))
            dice = 2 * len(pairs & other) / (len(pairs) + len(other))
            if dice >= threshold and (best is None or dice > best[1]):
                best = name, dice
        if best:
            yield line, *best, len(pairs)


def test_lines_whole_texts_and_changed_words(spark):
    wrapped = MIT.replace(". ", ".\n").replace("SOFTWARE", "PROGRAM", 1)
    texts = [
        "Intro.\nReleased under the MIT License.\nthe end", MIT, wrapped, "the license of the mit",
        "  RELEASED  under, the MIT license!! ", "All rights reserved", "", None, "x" * 300_000,
        "word " * 100_000 + "\nLicensed under CC BY-NC 4.0.", "Licensed under the MIT License. Released under the MIT License.",
    ]
    rows = [(k, text, "clash", 1.0) for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string, dice double")
    found = sorted(tuple(r) for r in scan_licenses(docs).collect())
    assert found == sorted((k, *hit) for k, text in enumerate(texts) if text for hit in brute(text))
    assert {(k, line) for k, line, *_ in found} >= {(0, 1), (1, 0), (2, -1), (4, 0), (5, 0), (9, 1)}
    assert scan_licenses(docs.unionAll(docs)).count() == 2 * len(found)
    assert scan_licenses(docs.limit(0)).count() == 0
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    assert sorted(tuple(r) for r in con.sql(license_sql()).fetchall()) == found


def test_main_path_has_no_python(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = scan_licenses(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_bounds_and_anchors_are_lossless():
    low, high = size_bounds(30, 0.8)
    assert 2 * 30 / (high + 30) <= 0.8 + 1e-9 and 2 * low / (low + 30) <= 0.8 + 1e-9
    anchors = set(anchor_words(TEMPLATES, 0.8))
    for body in TEMPLATES.values():
        pairs = template_bigrams(body)
        free = [pair for pair in pairs if not set(pair.split()) & anchors]
        assert 2 * len(free) / (len(free) + len(pairs)) < 0.8
