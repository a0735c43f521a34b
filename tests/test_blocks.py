"""Files cut into elements and records by many tasks, against whole-file parsing."""

import csv
import json
import random
from collections import Counter

import brokerage as b
import pytest
from pyspark.sql import functions as F

from ledgerlane.session import materialize
from ledgerlane.sources import blocks, delimited as dl, files as fl

SPEC = dl.fields(("id", "string"), ("t", "string"), ("n", "int"))


@pytest.fixture(params=["broadcast", "shuffle"])
def small_blocks(spark, request, monkeypatch):
    """Blocks of 700 bytes, with either way of giving blocks their entry."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    monkeypatch.setattr(blocks.cut_files, "__defaults__", (blocks.INDEX_BLOCKS if request.param == "broadcast" else 0,))
    yield spark
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def value(depth=0):
    if random.random() < 0.4 or depth > 3:
        return random.choice([1, 2.5, None, True, "a,b", 'q"[x],{', "\\", '\\\\"', "é€😀]}", "", [], {}, ",,,,"])
    if random.random() < 0.5:
        return [value(depth + 1) for _ in range(random.randrange(4))]
    return {f'k{i},"[': value(depth + 1) for i in range(random.randrange(4))}


def test_json_arrays_over_many_blocks(small_blocks, tmp_path):
    random.seed(5)
    everything = []
    for k, (indent, ascii_only) in enumerate([(None, True), (1, False), (0, False)]):
        rows = [value() for _ in range(250)] + ["x," * 1000] + [value() for _ in range(30)]
        (tmp_path / f"f{k}.json").write_text((" \n" if k == 1 else "") + json.dumps(rows, indent=indent, ensure_ascii=ascii_only) + ("\n" if k else ""))
        everything += rows
    for k, rows in enumerate([[], [1], ["]"], [[]], [" "]]):
        (tmp_path / f"g{k}.json").write_text(json.dumps(rows))
        everything += rows
    whole = {"a": 1, "b": [1, 2, {"c": '],["}'}]}
    (tmp_path / "h.json").write_text(json.dumps(whole))
    got = fl.read_json_array(small_blocks, str(tmp_path)).select(F.to_json("v").alias("j"))
    same = lambda x: json.dumps(x, sort_keys=True, ensure_ascii=False)
    assert Counter(same(json.loads(r.j)) for r in got.collect()) == Counter(map(same, [*everything, whole]))


def test_a_large_array_is_read_by_many_tasks(small_blocks, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps([{"k": k, "pad": "y" * 40} for k in range(2000)]))
    pieces = blocks.read_pieces(small_blocks, str(tmp_path), ",")
    effects = blocks.block_effects(pieces, blocks.JsonElements()).collect()
    assert len(effects) > 100 and max(e.n for e in effects) < 60
    assert fl.read_json_array(small_blocks, str(tmp_path)).selectExpr("sum(v:k::int) AS s").first().s == sum(range(2000))


def test_array_without_an_end(small_blocks, tmp_path):
    (tmp_path / "bad.json").write_text(json.dumps([{"k": k} for k in range(300)])[:-40])
    with pytest.raises(Exception, match="array not closed"):
        fl.read_json_array(small_blocks, str(tmp_path)).collect()


def cell():
    return random.choice(["x", "", "a b", "12", 'q"uo"te', "li\nne", '"', "\\", "back\\slash", "a,b", "\n\n", "é,€", "tail\\"])


def test_records_over_several_lines(small_blocks, tmp_path):
    """Doubled quotes with plain backslashes inside, escapes outside, line breaks in both."""
    random.seed(3)

    def put(v, quoted):
        return '"' + v.replace('"', '""') + '"' if quoted else "".join("\\" + c if c in ',\\\n"' else c for c in v)

    want = []
    for k in range(3):
        rows = [[cell() for _ in range(4)] for _ in range(300)]
        if k == 0:
            rows = [[c.replace("\n", " ") for c in r] for r in rows]
        body = "\n".join(",".join(put(c, k == 0 or random.random() < 0.5) for c in r) for r in rows)
        (tmp_path / f"f{k}.csv").write_text("h1,h2,h3,h4\n" + body + ("\n" if k != 1 else ""))
        want += [tuple(c or None for c in r) for r in rows]
    assert Counter(tuple(r) for r in dl.text_columns(small_blocks, str(tmp_path), 4).collect()) == Counter(want)
    # Only files in which a record goes over several lines take the longer way.
    assert sorted(f.rsplit("/", 1)[1] for f in dl._going_on(small_blocks, str(tmp_path), dl.CsvFormat())) == ["f1.csv", "f2.csv"]


def test_equals_the_standard_reader(small_blocks, tmp_path):
    random.seed(9)
    rows = [[random.choice(["p", "q\nr", "s,t", 'u"v', "", " w ", "\r\n"]) for _ in range(3)] for _ in range(400)]
    with open(tmp_path / "x.csv", "w", newline="") as out:
        csv.writer(out, lineterminator="\r\n").writerows(rows)
    fmt = dl.CsvFormat(skip_header=False, escape_unenclosed=None)
    got = Counter(tuple(r) for r in dl.text_columns(small_blocks, str(tmp_path), 3, fmt).collect())
    with open(tmp_path / "x.csv", newline="") as source:
        assert got == Counter(tuple(c or None for c in r) for r in csv.reader(source))


PROBE = 'id,t,n\n1,"x ""y"" z",1\n2,a\\,b,2\n3,"two\nlines",3\n4,ok,bad\n5,"never closed,5\n6,x,6\n7,y,7\n'


def test_declared_format_and_a_quote_without_an_end(small_blocks, tmp_path):
    (tmp_path / "p.csv").write_text(PROBE)
    tagged = dl.tag_rows(small_blocks, str(tmp_path), SPEC)
    rows = {r.id: r for r in tagged.collect()}
    assert [(rows[i].t, rows[i].n, rows[i].bad) for i in "123"] == [('x "y" z', 1, False), ("a,b", 2, False), ("two\nlines", 3, False)]
    assert rows["4"].errors == ["n"] and rows["5"].errors == [dl.UNCLOSED] and len(rows) == 5
    found = dl.validate_errors(small_blocks, str(tmp_path), SPEC).collect()
    assert sorted((r.line_no, r.column_name, r.line) for r in found) == [(6, "n", "4,ok,bad"), (7, dl.UNCLOSED, '5,"never closed,5')]
    assert [r.message for r in dl.rejects(tagged).collect() if r.errors == [dl.UNCLOSED]] == ["quote is never closed"]
    report = dl.load_report(tagged).first()
    assert (report.row_parsed, report.row_count, report.error_count, report.status) == (5, 3, 2, dl.PARTIAL)


def test_open_quote_swallows_later_blocks_in_one_row(small_blocks, tmp_path):
    lines = ["id,t,n"] + [f"{k},a,{k}" for k in range(500)] + ['500,"open,1'] + [f"{k},b,{k}" for k in range(501, 2000)]
    b.write(tmp_path / "open.csv", lines, "\n", True)
    tagged = materialize(dl.tag_rows(small_blocks, str(tmp_path), SPEC), "open")
    bad = tagged.filter("bad").collect()
    assert tagged.count() == 501 and len(bad) == 1 and bad[0].raw == ["500", '"open', "1"]
    assert [r.line_no for r in dl.validate_errors(small_blocks, str(tmp_path), SPEC).collect()] == [502]


def test_inner_escape_wide_delimiter_and_odd_quotes(spark, tmp_path):
    (tmp_path / "e.csv").write_text('1||"a\\"b""c||\\\\"||x"y\n2||q||r\\||s\n3||"t"tail||\n')
    fmt = dl.CsvFormat(delimiter="||", escape="\\", skip_header=False)
    got = sorted(tuple(r) for r in dl.text_columns(spark, str(tmp_path), 3, fmt).collect())
    assert got == [("1", 'a"b"c||\\', 'x"y'), ("2", "q", "r||s"), ("3", "ttail", None)]


def test_more_files_than_can_be_named(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dl, "MANY_FILES", 1)
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text(f'id,t,n\n{k},"a\nb",1\n')
    (tmp_path / "plain.csv").write_text("id,t,n\n9,c,1\n")
    assert sorted((r.id, r.t) for r in dl.tag_rows(spark, str(tmp_path), SPEC).collect()) == [("0", "a\nb"), ("1", "a\nb"), ("2", "a\nb"), ("9", "c")]
    assert dl.validate_errors(spark, str(tmp_path), SPEC).count() == 0
