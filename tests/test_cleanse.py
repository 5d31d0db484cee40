"""The CSV cleanse job: the reference's unit, fragment and end-to-end cases, plus edge rows."""

import glob
import gzip
import os

from pyspark.sql import functions as F

from cellmart.operators.projection import drop_columns
from cellmart.plans.text_flows import run_cleanse
from cellmart.sources.delimited import cleanse_csv, null_key_filter, read_lines, split_fields
from tests.conftest import rows

VALID = "plan,cells,note\nP7,12,north ring\nQ1,3,late fee waived\n"
NULL_KEY = "plan,cells,note\r\n,12,north ring\r\nQ1,3,late fee waived"


def write(path, text, gz=False):
    if gz:
        with gzip.open(path, "wt", newline="") as f:
            f.write(text)
    else:
        with open(path, "w", newline="") as f:
            f.write(text)
    return str(path)


def fields(spark, path, headers, sep=","):
    return split_fields(read_lines(spark, path), headers, sep)


def test_map_to_named_fields(spark, tmp_path):
    p = write(tmp_path / "valid.csv.gz", VALID, gz=True)
    got = fields(spark, p, ["plan", "cells", "note"]).drop("__cells")
    assert rows(got) == [{"plan": "P7", "cells": "12", "note": "north ring"},
                         {"plan": "Q1", "cells": "3", "note": "late fee waived"}]


def test_key_check_without_nulls(spark, tmp_path):
    p = write(tmp_path / "valid.csv.gz", VALID, gz=True)
    h = ["plan", "cells", "note"]
    got = null_key_filter(drop_columns(fields(spark, p, h), ""), "plan", h).drop("__cells")
    assert [r["plan"] for r in rows(got)] == ["P7", "Q1"]


def test_key_check_drops_empty_key(spark, tmp_path):
    p = write(tmp_path / "null_pk.csv", NULL_KEY)
    h = ["plan", "cells", "note"]
    got = null_key_filter(fields(spark, p, h), "plan", h).drop("__cells")
    assert rows(got) == [{"plan": "Q1", "cells": "3", "note": "late fee waived"}]


def test_remove_columns_to_csv_lines(spark, tmp_path):
    p = write(tmp_path / "valid.csv.gz", VALID, gz=True)
    df = cleanse_csv(spark, p, "plan,cells,note", "plan,cells", drop="note")
    lines = sorted(r[0] for r in df.select(F.concat_ws(",", "plan", "cells")).collect())
    assert lines == ["P7,12", "Q1,3"]


def _read_output(out):
    text = ""
    for f in sorted(glob.glob(os.path.join(out, "part-*"))):
        text += open(f).read()
    return [line for line in text.replace("\r\n", "\n").split("\n") if line]


def test_end_to_end_default_options(spark, tmp_path):
    p = write(tmp_path / "valid.csv.gz", VALID, gz=True)
    out = str(tmp_path / "out")
    run_cleanse(spark, p, out, "PLAN,CELLS,NOTE", "PLAN,CELLS,NOTE")
    lines = _read_output(out)
    assert lines[0] == "PLAN,CELLS,NOTE"
    assert sorted(lines[1:]) == ["P7,12,north ring", "Q1,3,late fee waived"]


def test_end_to_end_key_and_removed_column(spark, tmp_path):
    p = write(tmp_path / "valid.csv.gz", VALID, gz=True)
    out = str(tmp_path / "out")
    run_cleanse(spark, p, out, "PLAN,CELLS,NOTE", "PLAN,CELLS", primary_key="PLAN", columns_to_remove="NOTE")
    lines = _read_output(out)
    assert lines[0] == "PLAN,CELLS"
    assert sorted(lines[1:]) == ["P7,12", "Q1,3"]


def test_edge_rows(spark, tmp_path):
    text = ("ID,DESC,COMPANY\n"
            "70011,NORTH SITE,RELAY WEST\n"   # full row
            ",EMPTY KEY,X\n"                     # empty key -> dropped
            "11,SHORT\n"                         # short row: COMPANY absent -> fill
            "12,EXTRA,Y,SURPLUS\n"               # extra cell dropped
            "\n"                                 # blank line skipped
            '13,"A,B",Z\n')                      # quotes not interpreted: raw split
    p = write(tmp_path / "edge.csv", text)
    df = cleanse_csv(spark, p, "ID,DESC,COMPANY", "ID,DESC,COMPANY", primary_key="ID", fill="?")
    got = {r["ID"]: (r["DESC"], r["COMPANY"]) for r in df.collect()}
    assert got == {"70011": ("NORTH SITE", "RELAY WEST"), "11": ("SHORT", "?"),
                   "12": ("EXTRA", "Y"), "13": ('"A', 'B"')}


def test_short_row_without_key_cell_is_kept(spark, tmp_path):
    p = write(tmp_path / "short.csv", "A,B,KEY\n1,2\n3,4,\n5,6,k\n")
    df = cleanse_csv(spark, p, "A,B,KEY", "A,KEY", primary_key="KEY")
    assert sorted((r["A"], r["KEY"]) for r in df.collect()) == [("1", ""), ("5", "k")]


def test_absent_key_column_keeps_rows_and_pipe_separator(spark, tmp_path):
    p = write(tmp_path / "pipe.dat", "A|B\nx|\n|y\n")
    df = cleanse_csv(spark, p, "A,B", "A,B", primary_key="NOPE", sep="|")
    assert sorted((r["A"], r["B"]) for r in df.collect()) == [("", "y"), ("x", "")]


def test_removed_key_disables_the_check(spark, tmp_path):
    p = write(tmp_path / "k.csv", "K,V\n,1\nb,2\n")
    df = cleanse_csv(spark, p, "K,V", "V", primary_key="K", drop="K")
    assert sorted(r["V"] for r in df.collect()) == ["1", "2"]


def test_header_dropped_per_file(spark, tmp_path):
    d = tmp_path / "many"
    d.mkdir()
    write(d / "a.csv.gz", "h1,h2\n1,a\n", gz=True)
    write(d / "b.csv.gz", "h1,h2\n2,b\n", gz=True)
    df = cleanse_csv(spark, str(d / "*.csv.gz"), "h1,h2", "h1,h2")
    assert sorted(r["h1"] for r in df.collect()) == ["1", "2"]


def test_line_with_control_characters_stays_whole(spark, tmp_path):
    p = write(tmp_path / "ctl.csv", "A,B\nx\u0000y,z\n")
    df = cleanse_csv(spark, str(p), "A,B", "A,B")
    assert [(r.A, r.B) for r in df.collect()] == [("x\u0000y", "z")]
