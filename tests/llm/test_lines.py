from __future__ import annotations

import corpus_pipeline
from cases import awkward, documents, empty

from spreadlab.llm import lines
from spreadlab.llm.lines import LineParams


def brute(rows, params):
    """{row number: kept text} by plain counting."""
    sites = {}
    for _, text, _, source in rows:
        total, counts = sites.setdefault(source, [0, {}])
        sites[source][0] += 1
        for line in set(text.split("\n")) if text is not None else ():
            counts[line] = counts.get(line, 0) + 1
    out = []
    for doc, text, _, source in rows:
        total, counts = sites[source]
        out.append((doc, None if text is None else "\n".join(
            x for x in text.split("\n") if not x or counts[x] < params.min_pages or counts[x] <= params.ratio * total)))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rows = [(k, "\n".join([f"line {k}", "menu" if k % 3 else "other", "", "menu", f"shared {k % 40}", ""]), None, ("a", "b", None)[k % 7 % 3])
            for k in range(300)] + [(900, None, None, "a"), (901, "menu", None, "a"), (902, "menu", None, "tiny")]
    for params in (LineParams(), LineParams(ratio=0.01, min_pages=2, salts=3)):
        found = lines.drop_boilerplate(documents(spark, rows), params=params).collect()
        assert sorted(((r["doc_id"], r["text"]) for r in found), key=str) == brute(rows, params)
        assert all(r["lines_dropped"] == 0 for r in found if r["source"] == "tiny")


def test_columns_and_awkward_rows(spark, plan):
    source = awkward(spark, clashing=True)
    found = lines.drop_boilerplate(source)
    assert [c for c in found.columns if c != "lines_dropped"] == [c for c in source.columns if c != "lines_dropped"]
    assert found.count() == 10
    assert lines.drop_boilerplate(empty(spark)).count() == 0
    assert "Cartesian" not in plan(found)


def test_copies_of_a_page_are_one_vote(spark, folder):
    """A third of a host's pages are copies: the pipeline keeps exactly one, and the menu still goes."""
    copied = "\n".join(f"line {k} of a clean page that was copied often" for k in range(5))
    rows = [(k, copied, "en", "a") for k in range(50)]
    rows += [(100 + k, "menu\n" + " ".join(f"w{k}x{n}" for n in range(30)), "en", "a") for k in range(100)]
    rows += [(300, None, "en", "a"), (301, copied, "en", None), (302, copied, "en", None)]
    cleaned = corpus_pipeline.drop_lines(spark, documents(spark, rows), folder)
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_near_duplicates(spark, cleaned, folder).collect()}
    assert [doc for doc, text in kept.items() if text == copied] == [0]
    assert not any("menu" in (text or "") for text in kept.values()) and len(kept) == 102
