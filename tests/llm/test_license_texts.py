"""Entire licence texts, alone and inside longer texts, and notices after a copyright statement."""

import re
import textwrap

from footfall.llm import licenses


def test_entire_texts(spark):
    texts = licenses.TEXTS
    assert all(re.search(licenses.CUE, text.lower()) for _, text in texts)
    rows = [(2 * i, text) for i, (_, text) in enumerate(texts)]
    rows += [(2 * i + 1, "A program.\n\nA Licence\n" + licenses.without_title(text) + "\n\nThe end of it, and more words than a title has in it.")
             for i, (_, text) in enumerate(texts)]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    for i, (name, _) in enumerate(texts):
        assert found[2 * i].license == name
        assert name in found[2 * i].licenses.split(",") and name in found[2 * i + 1].licenses.split(",")
        assert found[2 * i + 1].license is None


def test_wrapped_and_cut_texts(spark):
    isc = " ".join(licenses.NOTICES[-1][1].split())
    mit = dict(licenses.TEXTS)["MIT"]
    rows = [(1, "Some program that does this and that for all of us\n\n" + textwrap.fill(isc, 50) + "\n\nMore of it."),
            (2, "ISC License\n" + textwrap.fill(isc, 60)),
            (5, "MIT License\n\n" + "\n\n".join(textwrap.fill(p, 70) for p in mit.split("\n\n"))),
            (3, mit[:mit.index("THE SOFTWARE IS PROVIDED")]), (4, mit.replace("without restriction", "with restrictions"))]
    found = {r.doc_id: (r.license, r.licenses) for r in licenses.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert found == {1: (None, "ISC"), 2: ("ISC", "ISC"), 3: (None, ""), 4: (None, ""), 5: ("MIT", "MIT")}


def test_texts_in_comments(spark):
    mit, apache = dict(licenses.TEXTS)["MIT"], [text for name, text in licenses.TEXTS if name == "Apache-2.0"]
    def marked(mark, text=mit):
        return "\n".join(mark + line for line in text.splitlines())
    code = "a = one + two + three + four + five + six + seven + eight + nine"
    rows = [(1, marked("# ")), (2, marked(" * ") + "\n"), (3, marked("# ") + "\n" + code),
            (4, "/*\n" + marked(" * ") + "\n */\n" + code), (5, min(apache, key=len)), (6, max(apache, key=len)),
            (7, marked("// ", mit.replace("free of charge", "for a charge")) + "\n" + code),
            (8, "# Copyright 2020 X. All rights reserved.")]
    found = {r.doc_id: (r.license, r.licenses) for r in licenses.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert found == {1: ("MIT", "MIT"), 2: ("MIT", "MIT"), 3: (None, "MIT"), 4: (None, "MIT"), 5: ("Apache-2.0", "Apache-2.0"),
                     6: ("Apache-2.0", "Apache-2.0"), 7: (None, ""), 8: (None, "all-rights-reserved")}


def test_cues_are_in_all_notices():
    assert all(re.search(licenses.LINE_CUE, text.lower()) for _, text in licenses.NOTICES)


def test_long_copyright_lines(spark):
    names = "Copyright " + "".join(f"A. Name {i}, Inc.; " for i in range(50_000))
    isc = " ".join(licenses.NOTICES[-1][1].split())
    rows = [(1, names + "All rights reserved."), (2, names), (3, names + isc), (4, names + "All -- rights... , reserved" + "." * 100_000)]
    found = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert found == {1: "all-rights-reserved", 2: "", 3: "ISC", 4: "all-rights-reserved"}


def test_notices_after_a_copyright_statement(spark):
    rows = [(1, "Text.\nCopyright 2020 X. All rights reserved."), (2, "Copyright J. Doe, Inc. Licensed under CC BY 4.0."),
            (3, "Copyright 2020 X.")]
    found = {r.doc_id: (r.n_lines, r.licenses)
             for r in licenses.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert found == {1: (1, "all-rights-reserved"), 2: (1, "CC-BY-4.0"), 3: (0, "")}
