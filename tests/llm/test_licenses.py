from footfall.llm import licenses

from .conftest import ROWS


def test_canonical_forms(spark):
    known = licenses.known(spark)
    texts = [
        (1, "RELEASED under the mit licence", "MIT"),
        (2, "Copyright (c) 2020 Someone\n  (C) 2021 Another\nReleased under the MIT License!", "MIT"),
        (3, "Licensed under Apache", None),
        (4, "Licensed under the Apache License, v2.0", "Apache-2.0"),
        (5, "© 2000 X\nThis work is licensed under a Creative Commons Attribution-Non-Commercial 4.0 International License",
         "CC-BY-NC-4.0"),
        (6, licenses.NOTICES[-1][1].replace("\n", "  ").upper(), "ISC"),
    ]
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id int, text string")
    found = {r.doc_id: r.license for r in licenses.scan(docs, known).collect()}
    assert found == {i: name for i, _, name in texts}


def test_lines(spark):
    docs = spark.createDataFrame([(1, "Some text.\nReleased under the MIT License.\n\nAll rights reserved.")],
                                 "doc_id int, text string")
    row = licenses.scan(docs).collect()[0]
    assert (row.license, row.n_lines, row.licenses) == (None, 2, "MIT,all-rights-reserved")


def test_odd_rows(odd, none):
    found = licenses.scan(odd).collect()
    assert len(found) == len(ROWS)
    assert {r.license for r in found if r.doc_id == 11} == {"Apache-2.0"}
    assert {r.digest for r in found if r.doc_id in (1, 2, 3)} == {None}
    assert licenses.scan(none).count() == 0
