"""The sheet reader against a plain reader of whole texts, however the files are split."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plotloom.sources import quoting
from plotloom.sources import sheets as S

SPLIT = "spark.sql.files.maxPartitionBytes"


def plain_records(text, skip):
    """Records of a text as (line, text, closed): one character after another."""
    lines = text.split("\n")
    if lines and lines[-1] == "":
        lines.pop()
    found, at = [], skip
    while at < len(lines):
        if not lines[at].strip():
            at += 1
            continue
        begin, state, record = at, "start", ""
        while True:
            for place, c in enumerate(lines[at]):
                if state == "start":
                    state = "quoted" if c == '"' else state if c in " \t," else "plain"
                elif state == "quoted":
                    state = "ended" if c == '"' else state
                elif state == "ended" and c == '"':
                    state = "quoted"
                elif c == ",":
                    state = "start"
                else:
                    state = "plain"
            record += lines[at]
            at += 1
            if state != "quoted" or at == len(lines):
                break
            record += "\n"
        found.append((begin, record, state != "quoted"))
    return found


def plain_cells(record):
    found, cell, state, blank = [], "", "start", True
    for c in record.removesuffix("\r") + ",":
        if state == "start" and c == '"' and blank:
            cell, state = "", "quoted"
        elif state == "quoted":
            state = "ended" if c == '"' else state
            cell += c if state == "quoted" else ""
        elif state == "ended" and c == '"':
            cell, state = cell + '"', "quoted"
        elif c == ",":
            found.append(cell.strip() if state == "start" else cell)
            cell, state, blank = "", "start", True
        elif state in ("ended", "after"):
            state, cell = "after", cell + c
        else:
            cell, blank = cell + c, blank and c in " \t"
    return found


def plain_read(text, skip):
    """(header, rows, rejects) of a text."""
    header, rows, bad = None, [], []
    for begin, record, closed in plain_records(text.removeprefix("﻿"), skip):
        if not closed:
            bad.append((S.OPEN_QUOTE, [record]))
            continue
        cells = quoting.cells(record.removesuffix("\r"))
        if header is None:
            header = cells
            continue
        surplus = [c for c in cells[len(header) :] if c]
        if surplus:
            bad.append((S.SURPLUS, surplus))
        rows.append((cells + [None] * len(header))[: len(header)])
    return header, rows, bad


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='ab ,"\t', max_size=14), st.booleans())
def test_state_at_the_end_of_a_line(line, inside):
    state = "quoted" if inside else "start"
    for c in line:
        if state == "start":
            state = "quoted" if c == '"' else state if c in " \t," else "plain"
        elif state == "quoted":
            state = "ended" if c == '"' else state
        elif state == "ended" and c == '"':
            state = "quoted"
        elif c == ",":
            state = "start"
        else:
            state = "plain"
    assert quoting.ends_inside(line, inside) == (state == "quoted")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet='ab ,"\n', max_size=6), min_size=1, max_size=5))
def test_quoted_cells_read_back(cells):
    assert quoting.cells(",".join('"' + c.replace('"', '""') + '"' for c in cells)) == cells


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet='ab ,"', max_size=14))
def test_cells_of_closed_lines(line):
    if not quoting.ends_inside(line, False) and '"' not in line.replace('"', "", 0):
        assert quoting.cells(line) == plain_cells(line)


def random_sheet(draw, skip, rows):
    def cell():
        kind = draw.random()
        if kind < 0.6:
            return draw.choice(["a", "12.5", " x ", "", "NA", "é"])
        inner = "".join(draw.choice(["a", ",", '""', "\n", " ", "\n\n", "ü"]) for _ in range(draw.randrange(12)))
        return f'"{inner}"'

    lines = [draw.choice(["note", 'open " quote', "", '"', "x,y"]) for _ in range(skip)]
    lines += [""] * draw.randrange(2)
    width = draw.randrange(2, 6)
    lines.append(",".join(draw.choice([f"c{i}", f'"c{i}"', f' "c\n{i}" ']) for i in range(width)))
    for _ in range(rows):
        if draw.random() < 0.1:
            lines.append(draw.choice(["", "  "]))
        lines.append(",".join(cell() for _ in range(max(1, width + draw.choice([-2, 0, 0, 0, 1])))))
    return "\n".join(lines) + draw.choice(["", "\n", ',"never closed\nx,y\n'])


@pytest.mark.parametrize("split, known, head", [(40, 1 << 20, 1 << 16), (150, 0, 1 << 16), (97, 1 << 20, 10), (1 << 27, 1 << 20, 1 << 16)])
def test_files_read_alike_however_they_are_split(spark, tmp_path, monkeypatch, split, known, head):
    draw = random.Random(split)
    skips, texts = [0, 3], {}
    monkeypatch.setattr(S, "KNOWN_BYTES", known)
    monkeypatch.setattr(S, "HEAD_BYTES", head)
    for skip in skips:
        for folder in ("north", "south"):
            for i in range(3):
                place = tmp_path / str(skip) / folder
                place.mkdir(parents=True, exist_ok=True)
                texts[(skip, folder, i)] = random_sheet(draw, skip, draw.randrange(1, 25))
                (place / f"2016_x_y_{i} +%.csv").write_bytes(texts[(skip, folder, i)].encode())
    spark.conf.set(SPLIT, split)
    try:
        for skip in skips:
            lines = S.scan(spark, [str(tmp_path / str(skip) / f) for f in ("north", "south")])
            rows = S.read_rows(lines, skip)
            found, tops = rows.collect(), S.headers(lines, skip).collect()
            bad = S.rejects(rows).collect()
            for folder in ("north", "south"):
                for i in range(3):
                    header, want, rejected = plain_read(texts[(skip, folder, i)], skip)
                    mine = lambda r: f"/{folder}/" in r["path"] and r["file"] == f"2016_x_y_{i} +%.csv"  # noqa: B023, E731
                    assert [list(r["header"]) for r in tops if mine(r)] == [header]
                    own = sorted((r["block_start"], r["line"], r["cells"]) for r in found if mine(r) and r["problem"] != S.OPEN_QUOTE)
                    assert [cells for *_, cells in own] == want
                    own = sorted((r["block_start"], r["line"], r["problem"], r["surplus"]) for r in bad if mine(r))
                    assert [(problem, surplus) for *_, problem, surplus in own] == rejected
    finally:
        spark.conf.unset(SPLIT)


def test_same_name_in_two_folders(spark, tmp_path):
    for folder, text in (("a", "ID,x_kg\n1,5\n"), ("b", "\nID,y_kg\n2,6,77\n")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "2016_GES_trial_Harvest.csv").write_text(text)
    lines = S.scan(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    cells = S.read_long(lines, ["ID"]).collect()
    assert sorted((r["ID"], r["name"], r["value"]) for r in cells) == [("1", "x_kg", "5"), ("2", "y_kg", "6")]
    (reject,) = S.rejects(S.read_rows(lines)).collect()
    assert reject["surplus"] == ["77"] and "/b/" in reject["path"]


def test_filters_on_the_name_leave_files_unread(spark, tmp_path):
    for name in ("2016_GES_trial_Harvest.csv", "2016_GES_trial_Lidar.csv"):
        (tmp_path / name).write_text("ID,a\n1,2\n")
    lines = S.scan(spark, str(tmp_path)).where("datatype = 'Lidar'")
    assert {r["file"] for r in S.read_rows(lines).collect()} == {"2016_GES_trial_Lidar.csv"}
    plan = lines._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    assert plan.collectLeaves().head().metrics().apply("numFiles").value() == 1


def test_empty_files_and_files_without_rows(spark, tmp_path):
    (tmp_path / "1_a_b_c.csv").write_text("")
    (tmp_path / "2_a_b_c.csv").write_text("\n\n")
    (tmp_path / "3_a_b_c.csv").write_text("ID,a")
    (tmp_path / "4_a_b_c.csv").write_bytes("﻿ID,a\r\n1,\"x\r\ny\"\r\n".encode())
    lines = S.scan(spark, str(tmp_path))
    assert {r["file"]: r["header"] for r in S.headers(lines).collect()} == {"3_a_b_c.csv": ["ID", "a"], "4_a_b_c.csv": ["ID", "a"]}
    (row,) = S.read_rows(lines).collect()
    assert row["cells"] == ["1", "x\r\ny"]
    assert S.read_columns(lines, ["a", "none"]).select("a", "none").collect() == [("x\r\ny", None)]


def test_lines_from_a_table(spark):
    rows = [("p/one.csv", "one.csv", 0, 2, "1,2"), ("p/one.csv", "one.csv", 0, 1, "a,b"), ("p/one.csv", "one.csv", 10, 5, 'x"'), ("p/one.csv", "one.csv", 0, 9, '3,"')]
    lines = spark.createDataFrame(rows, "path string, file string, block long, line long, value string").repartition(4)
    got = sorted((r["a"], r["b"]) for r in S.read_columns(lines, ["a", "b"]).collect())
    assert got == [("1", "2"), ("3", "\nx")]


def test_many_short_blocks_share_batches():
    """Blocks of a few lines each: what a task finds in them goes on in few batches, header by header."""
    import pyarrow as pa

    lines = [(f"p{b % 2}", f"f{b % 2}", b, f"{b},{i}" if b % 2 else f"{b}") for b in range(400) for i in range(3)]
    columns = [pa.array([line[i] for line in lines]) for i in range(4)]
    batch = pa.RecordBatch.from_arrays(columns, ["path", "file", "block", "value"])
    known = {
        (f"p{b % 2}", b): {"before": 3, "inside": False, "header": "x,y" if b % 2 else "x,y,z", "rest": None, "closed": True}
        for b in range(400)
    }
    made = list(S._records([batch], 0, known))
    rows = [row for part in made for row in part.to_pylist()]
    assert [(r["path"], r["file"], r["block_start"], r["line"]) for r in rows] == [
        (path, file, block, i % 3) for i, (path, file, block, _) in enumerate(lines)
    ]
    for row, (*_, block, value) in zip(rows, lines):
        assert row["header"] == (["x", "y"] if block % 2 else ["x", "y", "z"])
        assert row["cells"] == (value.split(",") if block % 2 else [value, None, None])
    assert len(made) <= 2
