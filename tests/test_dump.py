"""Plain dumps: rows by byte ranges, whatever the size of a range."""

import pytest
from fleet import frames

from skyledger.schemas import TABLES
from skyledger.sources import dump
from skyledger.sources.dump import dump_blocks, dump_source, value, write_dump

DUMP = """--
-- A dump
--
CREATE TABLE bookings.seats (aircraft_code character(3));
INSERT INTO x VALUES ('COPY bookings.no (a) FROM stdin');

COPY bookings.seats (aircraft_code, seat_no, "fare_conditions") FROM stdin;
773\t1A\tBusiness
773\t2A\t\\N
CN1\tCOPY bookings.seats (x) FROM stdin;\tEconomy
CN1\t1\\tB\\\\\\né\\x41\\101\tEconomy
\\.


COPY bookings.bookings (book_ref, book_date, total_amount) FROM stdin;
\\.

COPY bookings.aircrafts_data (model, aircraft_code, range) FROM stdin;
{"en": "Cessna \\\\"208\\\\""}\tCN1\t1200
\\.

COPY bookings.seats (seat_no, aircraft_code) FROM stdin;
9Z\tSU9
\\.
COPY bookings.cut (a) FROM stdin;
1
"""
SEATS = [
    ("773", "1A", "Business"), ("773", "2A", None), ("CN1", "COPY bookings.seats (x) FROM stdin;", "Economy"),
    ("CN1", "1\tB\\\néAA", "Economy"), ("SU9", "9Z", None),
]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("split", [1, 7, 64, 1 << 20])
def test_tables_of_one_file(spark, tmp_path, split):
    (tmp_path / "init.sql").write_text(DUMP)
    source = dump_source(spark, f"{tmp_path}/init.sql", split)
    assert rows(source("seats").select("aircraft_code", "seat_no", "fare_conditions")) == sorted(SEATS, key=repr)
    assert source("bookings").isEmpty()
    craft = source("aircrafts_data")
    assert dict(craft.dtypes)["range"] == "int"
    assert rows(craft.select("aircraft_code", "range", "model")) == [("CN1", 1200, '{"en":"Cessna \\"208\\""}')]
    for absent in ("cut", "no", "flights"):
        with pytest.raises(LookupError):
            source(absent)


def test_only_asked_tables_are_read(spark, tmp_path):
    (tmp_path / "init.sql").write_text(DUMP)
    blocks = dump_blocks(spark, f"{tmp_path}/init.sql", 50)
    data = DUMP.encode()
    assert {t: [data[a:b].count(b"\n") for _, a, b, _ in found] for t, found in blocks.items()} == {
        "seats": [4, 1], "bookings": [0], "aircrafts_data": [1]
    }


@pytest.mark.parametrize("name", list(TABLES))
def test_round_trip_of_every_table(spark, tmp_path, name):
    df = frames(spark)[name]
    for other in (name, "seats"):
        write_dump(frames(spark)[other].repartition(3), other, f"{tmp_path}/dump/{other}")
    back = dump_source(spark, f"{tmp_path}/dump", 100)(name)
    assert [(f.name, f.dataType) for f in back.schema.fields] == [(f.name, f.dataType) for f in df.schema.fields]
    assert rows(back) == rows(df)


def test_fields():
    fields = {"\\N": None, "": "", "\\\\N": "\\N", "a\\tb\\r": "a\tb\r", "\\x4a\\112\\q": "JJq"}
    assert {f: value(f) for f in fields} == fields


def test_short_ranges_do_not_become_a_task_each(spark, tmp_path):
    """Many short ranges and files are put together, so tasks do not grow with the dump before they are full."""
    (tmp_path / "init.sql").write_text(DUMP.replace("773\t1A\tBusiness\n", "773\t1A\tBusiness\n" * 5000))
    seats = dump_source(spark, f"{tmp_path}/init.sql", 64)("seats")
    assert seats.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert seats.count() == len(SEATS) + 4999


@pytest.mark.parametrize("text", ["a\r\n\n\nCOPY x.y (a) FROM stdin;\n\\.\nlong line\nb", "\n", "x", "\\.\r\nCOPY a (b) FROM stdin;"])
@pytest.mark.parametrize("chunk", [1, 3, 1 << 20])
def test_every_line_is_in_one_range(tmp_path, monkeypatch, text, chunk):
    monkeypatch.setattr(dump, "CHUNK", chunk)
    path, data = tmp_path / "d", text.encode()
    path.write_bytes(data)
    starts = [0, *(i + 1 for i, c in enumerate(data[:-1]) if c == 10)]
    for size in (1, 2, 5, 100):
        found = []
        for low in range(0, len(data), size):
            for at, lines in dump._chunks(str(path), low, min(low + size, len(data))):
                for line in lines.splitlines(keepends=True) if b"\r" not in lines else lines.replace(b"\r", b"").splitlines():
                    found.append(line)
        assert len(found) == len(starts)
        marks = [m for i, j in zip(starts, [*starts[1:], len(data)]) for m in dump._marks(i, data[i:j])]
        assert sorted(dump._marks(0, data)) == marks
