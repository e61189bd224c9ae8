"""Token ids, their ORC files, and packing."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewright.llm import packing, token_orc, tokens
from tablewright.llm.hashing import shingles, text_bytes, word_hashes
from tablewright.llm.queries import QUERIES, table
from tablewright.llm.tokens import Encoder, default_tokenizer

ODD = ["", None, "a", " ", "  a  b ", "x  y", "a   \nb c", "don't 1 2", "<|endoftext|> z", "<|endoftext|>", "x <|endoftext|> y", "x<|endoftext|><|endoftext|> <|endoftext|>  z ", "é à ü ", "\x1c x \x1f y", "a　 b  c", "tab\t x", "日本 語 x", "the the. \n\n the"]


def whole(texts):
    tokenizer = Tokenizer.from_file(default_tokenizer())
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


@pytest.mark.parametrize("texts", [ODD, ODD[::-1], ["".join(f" w{i}" for i in range(5000)), "w1 w2"]])
def test_segments_give_the_ids_of_whole_texts(texts):
    encoder = Encoder(default_tokenizer())
    for _ in range(2):
        ids, bounds = encoder.encode(*text_bytes(pa.array(texts, pa.string())))
        assert [ids[s:e].tolist() for s, e in zip(bounds[:-1], bounds[1:], strict=True)] == whole(texts)


def test_words_are_those_of_the_contract():
    texts = ["A b\x0bC  d", None, "", "É é Aa"]
    found, first = word_hashes(pa.array(texts, pa.string()))
    split = [w for t in texts for w in (t or "").encode().lower().split()]
    assert np.diff(first).tolist() == [4, 0, 0, 3]
    assert len(set(found.tolist())) == len(set(split))
    assert len(shingles(found[:4], 5)) == 1
    assert len(shingles(found[:0], 5)) == 0


def test_orc_round_trip_and_pruned_read(spark, docs, empty, tmp_path):
    token_orc.write_token_orc(docs, str(tmp_path / "t"))
    rows = token_orc.token_digest(token_orc.read_token_orc(spark, str(tmp_path / "t"))).collect()
    texts = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    ids = whole([t for _, t in texts])
    starts = np.cumsum([0, *map(len, ids)])
    wanted = [(k, int(s), len(i), crc32(np.array(i, "<u4").tobytes())) for (k, _), s, i in zip(texts, starts, ids, strict=False)]
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == wanted
    some = token_orc.read_token_orc(spark, str(tmp_path / "t"), [7, 10])
    assert {r.doc_id: len(r.ids) for r in some.collect()} == {7: len(whole(["two words"])[0]), 10: len(whole(["word " * 3000])[0])}
    assert "In(doc_id" in some._jdf.queryExecution().toString() or "doc_id IN" in some._jdf.queryExecution().toString()
    token_orc.write_token_orc(empty, str(tmp_path / "e"))
    assert token_orc.token_digest(token_orc.read_token_orc(spark, str(tmp_path / "e"))).count() == 0


def check_packing(pieces, capacity):
    used = {}
    for p in pieces:
        used.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for places in used.values():
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0, *[n for _, n in places]])[:-1].tolist()
        assert sum(n for _, n in places) <= capacity
    return len(used)


def test_packing_of_documents(spark, docs, empty):
    cut = packing.pieces(docs, capacity=64)
    packed = packing.pack(cut, 64, order=("doc_id", "piece", "ids_crc32")).collect()
    ids = {r.doc_id: i for r, i in zip(docs.collect(), whole([r.text for r in docs.collect()]), strict=True)}
    for p in packed:
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert p.ids_crc32 == crc32(np.array(part, "<u4").tobytes())
        assert p.piece == 0 or p.length == 64
    total = sum(p.length for p in packed)
    assert total == sum(len(ids[r.doc_id]) for r in docs.collect())
    assert check_packing(packed, 64) == -(-total // 64)
    assert packing.pack(packing.pieces(empty)).count() == 0


def test_a_length_that_most_rows_share(spark):
    items = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, 30).otherwise(F.col("id") % 40 + 1).cast("long").alias("length"))
    packed = packing.pack(items, 100, order=("id",)).collect()
    assert len(packed) == 3000
    counts = np.bincount([p.length for p in packed], minlength=101)
    fit = packing.best_fit_decreasing(counts, 100)
    assert packing.least_sequences(counts, 100) <= check_packing(packed, 100) <= sum(n for _, n in fit)
    with pytest.raises(ValueError, match="exist already"):
        packing.pack(items.withColumn("offset", F.lit(1)), 100)
    with pytest.raises(Exception, match="length must lie"):
        packing.pack(items.withColumn("length", F.lit(0).cast("long")), 100).collect()


def best(sizes, capacity):
    """Fewest sequences by trying everything."""
    def search(i, rooms):
        if i == len(sizes):
            return len(rooms)
        found = search(i + 1, [*rooms, capacity - sizes[i]])
        for k, room in enumerate(rooms):
            if room >= sizes[i] and room not in rooms[:k]:
                found = min(found, search(i + 1, [*rooms[:k], room - sizes[i], *rooms[k + 1 :]]))
        return found

    return search(0, [])


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_optimal_on_small_input(seed):
    rng = np.random.default_rng(seed)
    sizes = sorted(rng.integers(3, 21, 9).tolist(), reverse=True)
    counts = np.bincount(sizes, minlength=21)
    plan = packing.plan_lengths(counts, 20)
    got = np.zeros(21, int)
    for pattern, number in plan:
        assert sum(pattern) <= 20
        np.add.at(got, list(pattern), number)
    assert got.tolist() == counts.tolist()
    assert sum(n for _, n in plan) == best(sizes, 20) >= packing.least_sequences(counts, 20)


@pytest.mark.parametrize("name", ["op1_token_orc", "op10_best_fit_packing"])
def test_queries_cover_every_token(spark, sf_dir, name):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    ids = dict(zip(texts, whole(texts.values()), strict=True))
    rows = QUERIES[name](spark, sf_dir).collect()
    if name.startswith("op1_"):
        assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in rows} == {k: (len(i), crc32(np.array(i, "<u4").tobytes())) for k, i in ids.items()}
        ends = sorted((r.start, r.start + r.n_tokens) for r in rows)
        assert [s for s, _ in ends] == [0, *[e for _, e in ends[:-1]]]
    else:
        assert sum(r.length for r in rows) == sum(map(len, ids.values()))
        check_packing(rows, 1024)


def test_a_call_of_the_tokenizer_takes_few_bytes(monkeypatch):
    """However many segments are new, and the ids stay those of whole texts."""
    encode_texts = tokens.Encoder(tokens.default_tokenizer())
    library, calls = encode_texts._tokenizer, []

    class Watched:
        def encode_batch_fast(self, texts, add_special_tokens):
            calls.append([len(t.encode()) for t in texts])
            return library.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    monkeypatch.setattr(encode_texts, "_tokenizer", Watched())
    texts = [" ".join(f"w{i}é{k}" for i in range(4000)) + "  " * k + "x" * 50_000 * k for k in range(8)]
    ids, bounds = encode_texts.encode(*text_bytes(pa.array(texts)))
    for k, text in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]
    assert sum(map(sum, calls)) > 2 * tokens.CALL_BYTES
    assert all(sum(sizes) <= tokens.CALL_BYTES or len(sizes) == 1 for sizes in calls)


def test_starts_are_found_without_reading_the_ids_again(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"a{i} b c" * (i % 5)) for i in range(200)], "doc_id long, text string").repartition(4)
    token_orc.write_token_orc(docs, str(tmp_path / "t"))
    found = token_orc.token_digest(token_orc.read_token_orc(spark, str(tmp_path / "t")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line[line.index("ReadSchema") :] for line in plan.splitlines() if "ReadSchema" in line]
    assert [("ids" in scan) for scan in scans].count(True) == 1 and len(scans) == 2
    want = [len(ids) for ids in whole([r.text for r in docs.orderBy("doc_id").collect()])]
    rows = found.orderBy("doc_id").collect()
    assert [r.n_tokens for r in rows] == want and [r.start for r in rows] == [0, *np.cumsum(want)[:-1].tolist()]


def test_new_segments_are_put_between_the_known_ones():
    encoder = Encoder(default_tokenizer())
    for i in range(6):
        texts = [f"w{j * 7919 % 1000 + i * 300} x{j % 3 + i}  y\n" for j in range(500)]
        ids, bounds = encoder.encode(*text_bytes(pa.array(texts)))
        assert [ids[s:e].tolist() for s, e in zip(bounds[:-1], bounds[1:], strict=True)] == whole(texts)
        assert (encoder._keys[1:] > encoder._keys[:-1]).all()
        assert len(encoder._at) == len(encoder._size) == len(encoder._keys)
