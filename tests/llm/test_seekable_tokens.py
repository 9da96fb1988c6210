import io
import os
import zlib

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from recordforge.llm import seekable_tokens as S
from recordforge.llm.tokens import tokenizer_path


def ids(*values):
    return np.asarray(values, dtype="<u4").tobytes()


def written(docs, frame_ids=4):
    out = io.BytesIO()
    w = S.SeekableWriter(out, frame_ids)
    for d in docs:
        w.add(*d)
    w.close()
    return out.getvalue()


DOCS = [(None, ids(9)), (1, ids(1, 2, 3)), (2, ids()), (5, ids(4, 5, 6, 7, 8)), (5, ids(1)), (9, ids(2))]


def test_round_trip_and_random_access():
    data = written(DOCS)
    reader = S.SeekableReader(io.BytesIO(data), len(data))
    assert [d for k in range(len(reader.frames)) for d in reader.frame(k)] == DOCS
    assert reader.find(5) == [ids(4, 5, 6, 7, 8), ids(1)] and reader.find(3) == [] and reader.find(9) == [ids(2)]


def test_reader_opens_only_the_frames_it_needs():
    data = written([(i, ids(*range(50))) for i in range(100)], 50)
    reader = S.SeekableReader(io.BytesIO(data), len(data))
    opened = []
    frame = reader.frame
    reader.frame = lambda k: opened.append(k) or frame(k)
    assert reader.find(70) == [ids(*range(50))] and opened == [70]


def test_frames_are_standard_zstandard():
    data = written(DOCS)
    raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert ids(4, 5, 6, 7, 8) in raw


def test_damage_is_found():
    data = bytearray(written(DOCS))
    reader = S.SeekableReader(io.BytesIO(bytes(data)), len(data))
    reader.frames[0, 2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        reader.frame(0)
    with pytest.raises(ValueError):
        S.SeekableReader(io.BytesIO(b"x" * 40), 40)


def test_files_round_trip(spark, docs, tmp_path):
    rows = [(i * 3, f"Text number {i}, of some length " * (i % 5)) for i in range(200)] + [(7, None), (8, ""), (9, "long " * 50_000), (9, "again")]
    got = S.token_files(docs(rows).repartition(6), str(tmp_path / "files"), frame_ids=100).orderBy("start").collect()
    tok = Tokenizer.from_file(tokenizer_path(None))
    at = 0
    for (key, text), r in zip(sorted(rows, key=lambda x: (x[0], x[1] or "")), got, strict=True):
        want = np.asarray([*tok.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        assert (r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) == (key, at, len(want), zlib.crc32(want.tobytes()))
        at += len(want)
    some = S.read_token_files(spark, str(tmp_path / "files"), only=[9, 300, 1]).orderBy("start").collect()
    assert some == [r for r in got if r.doc_id in (9, 300)]
    assert not [f for f in os.listdir(tmp_path / "files" / "ids") if f.endswith(".tmp")]


def test_null_ids_and_empty_table(docs, tmp_path):
    got = S.token_files(docs([(None, "a"), (3, "b")]), str(tmp_path / "a")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 3]
    assert S.token_files(docs([]), str(tmp_path / "b")).collect() == []


def test_a_hot_id_is_spread_over_files(spark, docs, tmp_path):
    rows = [(None if i % 3 == 0 else i, f"{i * 7919 % 3001} words of a text") for i in range(3000)]
    folder = str(tmp_path / "files")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    try:
        spark.conf.set(coalesce, "false")
        sizes = [r.n_docs for r in S.write_token_files(docs(rows), folder).collect()]
    finally:
        spark.conf.set(coalesce, before)
    assert sum(sizes) == 3000 and len(sizes) > 4 and max(sizes) < 2 * 3000 / len(sizes)
    got = [r.doc_id for r in S.read_token_files(spark, folder).orderBy("start").collect()]
    assert got == sorted((k for k, _ in rows), key=lambda k: -1 if k is None else k)
