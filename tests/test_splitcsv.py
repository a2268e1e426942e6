"""Quoted line breaks in files of several splits, against a parser that reads the whole file."""

import csv
import gzip
import io
import random

import pytest

from marketlens.sources import readers, splitcsv

TEXTS = [
    "",
    "a;b",
    '"a;b',
    "\r\n\r\na;b\r\r\n  \r\n;;\n",
    '"1";"one\r\ntwo"\r\n"2";"x ""y"" z"\r\n',
    '1;a"b\r\n2;"c"d"e;"f\r\ng"\r\n"3',
    '1;"' + "line\r\n" * 40 + '"\r\n2;x\r\n',
    'é;"ç\n";"\n";\n\n"";""\r\n"a""\n""b";\r',
]


def plain(text, sep=";"):
    return [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=sep) if r]


def whole_state(text, sep=";"):
    """The state after a text, one character at a time."""
    state = splitcsv.RECORD
    for c in text:
        if state == splitcsv.QUOTED:
            state = splitcsv.CLOSING if c == '"' else state
        elif c in "\r\n":
            state = splitcsv.RECORD
        elif c == sep:
            state = splitcsv.CELL
        elif c == '"' and state in (splitcsv.RECORD, splitcsv.CELL, splitcsv.CLOSING):
            state = splitcsv.QUOTED
        else:
            state = splitcsv.BARE
    return state


def noise(seed, length):
    rng = random.Random(seed)
    return "".join(rng.choice('ab;"\r\n"" ') for _ in range(length))


@pytest.mark.parametrize("text", [*TEXTS, *(noise(s, 60) for s in range(150))])
def test_states_of_splits(text):
    prefixes = splitcsv._prefixes(";")
    for size in (1, 3, 7, 1000):
        for at in range(0, len(text), size):
            part = text[at : at + size]
            ends, firsts = splitcsv.scan(part.encode("latin-1"), ";")
            for state, prefix in enumerate(prefixes):
                assert ends[state] == whole_state(prefix + part), (part, state)
                after = [i for i in range(len(part)) if whole_state(prefix + part[:i]) == splitcsv.RECORD]
                # between the two characters of a line end no record begins, or an empty one does
                after = [i for i in after if not (i and part[i - 1 : i + 1] == "\r\n")]
                assert firsts[state] == (after[0] if after else None), (part, state)


@pytest.mark.parametrize("size", [1, 5, 64])
def test_records_of_many_splits(spark, tmp_path, size):
    expected = {}
    for n, text in enumerate([*TEXTS, noise(1000, 90), noise(1001, 90)]):
        path = tmp_path / f"f{n}.csv"
        path.write_bytes(text.encode("latin-1"))
        expected[str(path)] = plain(text)
    rows = [(p, len(open(p, "rb").read())) for p in expected]
    rows = rows if size > 1 else rows[:6]
    got = {p: [] for p, _ in rows}
    for r in splitcsv.read_records(spark.createDataFrame(rows, "path string, size long"), split_bytes=size).collect():
        got[r.path].append(list(r.cells))
    assert got == {p: expected[p] for p, _ in rows}


def test_one_file_takes_many_tasks(spark, tmp_path):
    rows = [[f"{i:07}", f"line\n{i} \"q\"" if i % 3 else "plain"] for i in range(3000)] + [["9", "stray"]]
    text = "".join(";".join('"' + c.replace('"', '""') + '"' for c in row) + "\r\n" for row in rows[:-1]) + '9;st"ray\r\n'
    path = tmp_path / "cnaes.csv"
    path.write_bytes(text.encode("latin-1"))
    table = readers.read_files(spark, "cnaes", [str(path)], split_bytes=8 << 10)
    expected = plain(text)
    assert [[r.cnae, r.descricao_cnae] for r in table.collect()] == expected and len(expected) == 3001
    assert table.rdd.getNumPartitions() == -(-len(text) // (8 << 10)) > 8
    filled = table.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(n > 0 for n in filled) > 8 and max(filled) < 600
    assert {r.source for r in table.select("source").distinct().collect()} == {str(path)}


def test_headered_files_in_splits_keep_their_order(spark, tmp_path):
    body = "".join(f'"m\n{i}";{i};\r\n' for i in range(900)) + " \r\nshort\r\n1;2;3;4\r\n"
    path = tmp_path / "pib.csv"
    path.write_bytes(("﻿\"Muni\ncípio\";PIB;Pop\r\n" + body).encode())
    table = readers.read_headered(spark, str(path), ";", "utf-8", split_bytes=1 << 10)
    assert table.columns == ["Muni\ncípio", "PIB", "Pop"]
    expected = [tuple([*(c or None for c in r[:3]), None, None, None][:3]) for r in plain(body)]
    assert [tuple(r) for r in table.collect()] == expected and len(expected) == 903


def test_lines_of_blanks_are_records(spark, tmp_path):
    (tmp_path / "cnaes.csv").write_bytes(b"1;a\r\n  \r\n\r\n2;b\r\n")
    (tmp_path / "cnaes_plain.csv").write_bytes(b"3;c\r\n\r\n")
    paths = [str(tmp_path / "cnaes.csv"), str(tmp_path / "cnaes_plain.csv")]
    assert set(readers.irregular_files(spark, paths).values()) == {False}
    got = sorted((r.cnae or "", r.descricao_cnae) for r in readers.read_files(spark, "cnaes", paths).collect())
    assert got == [("", None), ("1", "a"), ("2", "b"), ("3", "c")]
    assert readers.read_files(spark, "cnaes", paths, multiline=False).count() == 3


def test_compressed_files_are_read_whole(spark, tmp_path):
    (tmp_path / "cnaes.csv.gz").write_bytes(gzip.compress(b'1;"a\nb"\n2;c\n'))
    table = readers.read_files(spark, "cnaes", [str(tmp_path / "cnaes.csv.gz")])
    assert sorted((r.cnae, r.descricao_cnae) for r in table.collect()) == [("1", "a\nb"), ("2", "c")]
    assert not splitcsv.splittable("a.csv", "utf-16") and splitcsv.splittable("a.csv", "latin-1")
