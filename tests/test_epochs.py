"""A run that replaces dates gives the same table wherever it breaks."""

from __future__ import annotations

import datetime as dt

import pytest

from spreadlab.streaming import ingest

SCHEMA = "d date, k string, v double"


def day(n):
    return dt.date(2024, 5, n)


def drop_files(spark, feed, version):
    """Two files that share a date, so that it is spread over two batches."""
    for part in range(2):
        rows = [(day(d), f"k{part}{i}", float(version)) for d in ((1, 2) if version == 1 else (2, 3)) for i in range(3)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(feed)


def run(spark, base):
    stream = ingest.file_stream(spark, f"{base}/in", spark.createDataFrame([], SCHEMA).schema, max_files=1)
    ingest.replace_new_dates(stream, f"{base}/table", f"{base}/state", "d")


def content(spark, base):
    return sorted(tuple(r) for r in spark.read.parquet(f"{base}/table").select("d", "k", "v").collect())


class Broken(Exception):
    pass


def breaking(monkeypatch, name, call):
    """The given call of a step raises, once it is done or before it starts."""
    plain, calls = getattr(ingest, name), []
    number, after = call

    def step(*a, **kw):
        calls.append(a)
        if len(calls) == number and not after:
            raise Broken(name)
        out = plain(*a, **kw)
        if len(calls) == number and after:
            raise Broken(name)
        return out
    monkeypatch.setattr(ingest, name, step)


STEPS = [("_run", (1, True)), ("_mark", (1, False)), ("_mark", (1, True)), ("replace_dates", (1, False)), ("replace_dates", (1, True)),
         ("_mark", (2, False)), ("_mark", (2, True)), ("_remove", (1, False)), ("_remove", (1, True)), ("_remove", (2, True)), ("_remove", (3, False))]


@pytest.mark.parametrize("name,call", STEPS)
def test_broken_runs_end_like_whole_ones(spark, tmp_path, monkeypatch, name, call):
    want = sorted([(day(1), f"k{p}{i}", 1.0) for p in range(2) for i in range(3)]
                  + [(day(d), f"k{p}{i}", 2.0) for d in (2, 3) for p in range(2) for i in range(3)])
    base = str(tmp_path)
    drop_files(spark, f"{base}/in", 1)
    with monkeypatch.context() as patched:
        breaking(patched, name, call)
        with pytest.raises(Broken):
            run(spark, base)
    if name == "_run" or (name, call) == ("_mark", (1, False)):
        run(spark, base)  # a run that broke while gathering is gone on with, before newer files arrive
    drop_files(spark, f"{base}/in", 2)
    run(spark, base)
    assert content(spark, base) == want
    run(spark, base)
    assert content(spark, base) == want and not ingest.exists(spark, f"{base}/state-gathered")


def test_a_batch_that_fails_is_gathered_once(spark, tmp_path):
    base, seen = str(tmp_path), []
    drop_files(spark, f"{base}/in", 1)

    def once(df):
        seen.append(1)
        if len(seen) == 2:
            raise Broken("second batch")
        return df
    stream = lambda: ingest.file_stream(spark, f"{base}/in", spark.createDataFrame([], SCHEMA).schema, max_files=1)
    with pytest.raises(Exception, match="second batch"):
        ingest.replace_new_dates(stream(), f"{base}/table", f"{base}/state", "d", once)
    ingest.replace_new_dates(stream(), f"{base}/table", f"{base}/state", "d", once)
    assert content(spark, base) == sorted((day(d), f"k{p}{i}", 1.0) for d in (1, 2) for p in range(2) for i in range(3))
