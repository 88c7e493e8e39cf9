import hashlib
import random
import struct

import zstandard
from pyspark.sql import functions as F

from evenkeel.llm import archive

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    first = {}
    for page_id, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 100:
            key = (page_id is None, page_id or 0)
            first[payload] = min(first.get(payload, key), key)
    out, seen = [], set()
    for page_id, _, html in rows:
        payload = (html or "").encode()
        digest = hashlib.sha256(payload).hexdigest()
        revisit = len(payload) >= 100 and (first[payload] != (page_id is None, page_id or 0) or payload in seen)
        if len(payload) >= 100 and not revisit:
            seen.add(payload)
        refers_to = (None if first[payload][0] else first[payload][1]) if revisit else None
        out.append((page_id, len(payload), digest, "revisit" if revisit else "response", refers_to))
    return sorted(out, key=repr)


def read_back(spark, rows):
    out = archive.read_archives(archive.archive_pages(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    return sorted((tuple(row)[:5] for row in out.collect()), key=repr), {row.payload_digest: bytes(row.block) for row in out.collect() if row.record_type == "response"}


def sample():
    rng = random.Random(4)
    bodies = ["<html>" + "".join(rng.choices("abc <p>é😀\r\n\x00", k=rng.randint(60, 3000))) for _ in range(40)]
    rows = [(n, f"http://h{n % 5}.example/{n}", rng.choice([*bodies, bodies[0], bodies[0], "short", "", None])) for n in range(300)]
    return rows + [(500, None, "x\r\n\r\n" * 90_000), (501, "u\r\nv", "y" * 99), (502, "u", "y" * 99), (2**62 + 1, "u", "z" * 100), (2**62 + 3, "u", "z" * 100)]


def test_round_trip_and_revisits(spark):
    rows = sample()
    found, blocks = read_back(spark, rows)
    assert found == brute(rows)
    for _, _, html in rows:
        payload = (html or "").encode()
        assert blocks[hashlib.sha256(payload).hexdigest()] == payload


def test_ties_and_nulls(spark):
    body = "w" * 200
    rows = [(7, "a", body), (7, "a", body), (7, "b", body), (None, "c", body), (None, None, "v" * 150), (None, None, "v" * 150), (None, None, None)]
    found, _ = read_back(spark, rows)
    assert found == brute(rows)


def test_empty_table(spark):
    frames = archive.archive_pages(spark.createDataFrame([], SCHEMA))
    assert frames.count() == 0 and archive.read_archives(frames).count() == 0


def test_frames_are_a_file_with_its_dictionary_first(spark, tmp_path):
    rows = [(n, f"http://h.example/{n}", f"<html><body class='main page'>{n} " + "some words " * 40) for n in range(60)]
    frames = archive.archive_pages(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    name = frames.select("archive").distinct().collect()
    assert len(name) == 1
    path = tmp_path / "a.warc.zst"
    archive.save_file(frames, name[0].archive, str(path))
    data = path.read_bytes()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D
    reader = zstandard.ZstdDecompressor(dict_data=archive._dictionary(data[8 : 8 + size]))
    records = reader.stream_reader(data[8 + size :], read_across_frames=True).read()
    assert records.count(b"WARC/1.1\r\n") == 60
    assert frames.where("frame > 0").select(F.max(F.length("body"))).first()[0] < len(records) / 60 / 2


def test_archives_close_at_their_size():
    records = [archive.record_bytes(n, "u", b"p" * 300, 300, "d", "response", None) for n in range(10)]
    assert list(archive.unpack(archive.pack(records))) == records
    assert archive.parse_record(records[3])[1] == b"p" * 300
