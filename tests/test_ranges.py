"""Quoted text read range by range: equal to the whole-file read, whatever the ranges."""

import os
import random
from collections import Counter, defaultdict
from contextlib import contextmanager

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordlens.sources import ranges
from recordlens.sources.delimited import read_delimited
from tests.conftest import write_text


@contextmanager
def small_ranges(spark, size):
    """Ranges of about ``size`` bytes."""
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def number_of_ranges(spark, paths):
    return ranges.text_lines(spark, paths).select("file", "start").distinct().count()


CELLS = ["plain", "", "two\nlines", 'a "word"', '"', '""', "tab\there", "\n", "\n\n", "x\r\ny", '"\n"', "é\n日本", "end\\", "," * 3, "long " * 60 + "\n" + "text " * 50]


@pytest.mark.parametrize("size", [90, 1 << 20])
def test_well_formed_files_equal_pandas(spark, tmpdir_fresh, size):
    rng = random.Random(size)
    want = {}
    for f in range(6):
        rows = [(f"{f}-{k}", rng.choice(CELLS), rng.choice(CELLS)) for k in range([0, 1, 25, 20][f % 4])]
        path = os.path.join(tmpdir_fresh, f"f{f}.tsv")
        pd.DataFrame(rows, columns=["id", "a", "b"]).to_csv(path, sep="\t", index=False, lineterminator="\r\n" if f == 3 else "\n")
        want[f"f{f}.tsv"] = [tuple(x or None for x in r) for r in rows]
    paths = [os.path.join(tmpdir_fresh, f) for f in sorted(want)]
    with small_ranges(spark, size):
        got = defaultdict(list)
        for r in sorted(read_delimited(spark, paths, row_order=True, with_source_file=True).collect(), key=lambda r: r.row_order):
            got[r.source_file].append(tuple(x or None for x in (r.id, r.a, r.b)))
        if size == 90:
            assert number_of_ranges(spark, paths) > 20
    assert dict(got) == {f: rows for f, rows in want.items() if rows}


def test_any_text_equals_whole_file_read(spark, tmpdir_fresh):
    """Stray quotes, unclosed cells, ragged and blank lines: the same rows as the parser that sees the whole file."""
    rng = random.Random(5)
    paths = []
    for f in range(60):
        body = "".join(rng.choice(['"', '"', "\t", "\n", "\n", "a", "b c", '""', '\t"', '"\t', '"\n']) for _ in range(rng.choice([3, 20, 80])))
        paths.append(write_text(os.path.join(tmpdir_fresh, f"r{f:03}.tsv"), "x\ty\tz\n" + body + "\nend"))
    whole = Counter(map(tuple, read_delimited(spark, paths, multiline=True, with_source_file=True).collect()))
    for size in (40, 1 << 20):
        with small_ranges(spark, size):
            got = Counter(tuple(r) for r in read_delimited(spark, paths, with_source_file=True).collect())
        assert got == whole


def test_one_large_cell_file_is_read_by_many_tasks(spark, tmpdir_fresh):
    rows = [(str(k), f'text "{k}"\nsecond line {k}\n') for k in range(20_000)]
    path = os.path.join(tmpdir_fresh, "big.tsv")
    pd.DataFrame(rows, columns=["id", "text"]).to_csv(path, sep="\t", index=False)
    with small_ranges(spark, 64 << 10):
        df = read_delimited(spark, path)
        assert df.rdd.getNumPartitions() > 3 and number_of_ranges(spark, [path]) > 10
        assert sorted(map(tuple, df.collect())) == sorted(rows)
        assert df.select("id").count() == 20_000


def test_overlong_rows_stay_out_when_columns_are_pruned(spark, tmpdir_fresh):
    path = write_text(os.path.join(tmpdir_fresh, "g.tsv"), 'a\tb\n1\t"x\ny"\n2\tok\textra\n3\t"p\tq"\n4\n')
    got = read_delimited(spark, path, columns=["a"], row_order=True).collect()
    assert [(r.a, r.row_order & (1 << ranges.LINE_BITS) - 1) for r in sorted(got, key=lambda r: r.row_order)] == [("1", 1), ("3", 4), ("4", 5)]


def test_changed_ranges_raise(spark, tmpdir_fresh):
    path = write_text(os.path.join(tmpdir_fresh, "g.tsv"), "a\tb\n" + '1\t"x\ny"\n' * 200)
    with small_ranges(spark, 300):
        df = read_delimited(spark, path)
        assert df.count() == 200
    with small_ranges(spark, 100), pytest.raises(Exception, match="changed while it was read"):
        df.collect()


def brute_inside(text, inside, sep="\t"):
    """State after a text, character by character."""
    state = "in" if inside else "start"
    k = 0
    while k < len(text):
        c = text[k]
        if state == "start":
            state = "in" if c == '"' else "start" if c == sep else "plain"
        elif state == "plain":
            state = "start" if c == sep else "plain"
        elif c == '"':
            if text[k + 1:k + 2] == '"':
                k += 1
            else:
                state = "plain"
        k += 1
    return state == "in"


@given(st.text('"\ta', max_size=14), st.booleans())
@settings(max_examples=600, deadline=None)
def test_state_of_a_line(line, inside):
    assert ranges.ends_inside(line.encode(), inside, b"\t") == brute_inside(line, inside)
