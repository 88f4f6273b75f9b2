from __future__ import annotations

from cases import awkward, documents, empty

from spreadlab.llm import licenses


def scanned(df):
    return [(r["doc_id"], r["license"], r["notices"], r["n_notices"]) for r in licenses.scan(df).orderBy("doc_id").collect()]


def test_entire_texts_in_other_spelling(spark):
    mit = dict(licenses.KNOWN[:1])["MIT"]
    rows = [(1, mit), (2, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace("LICENSE", "LICENCE").replace(" ", "  ")),
            (3, mit + " And more."), (4, "Some prose.\nReleased under the MIT licence!\n")]
    found = scanned(documents(spark, rows))
    assert found[0][:3] == (1, "MIT", "MIT") and found[1][:3] == (2, "MIT", "MIT")
    assert found[2][1] is None and found[3] == (4, None, "MIT", 1)


def test_every_known_text_is_found(spark):
    rows = [(k, text) for k, (_, text) in enumerate(licenses.KNOWN)]
    assert [f[1] for f in scanned(documents(spark, rows))] == [name for name, _ in licenses.KNOWN]


def test_awkward_rows(spark):
    found = licenses.scan(awkward(spark, clashing=True)).collect()
    assert len(found) == 10 and all(r["license"] is None and r["n_notices"] == 0 for r in found)
    assert licenses.scan(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark, plan):
    text = plan(licenses.scan(awkward(spark)))
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
