import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logtide.llm import chunk_bpe, packing, token_counts
from logtide.llm.common import SALTS, attach, row_salt
from logtide.llm.pieces import ENTRY_BYTES, Generations, Pieces
from tests.llm.helpers import DOC_SCHEMA, doc_rows

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ALPHABET = list("abcXYZ éßΣσİ½²'’\n\t  \r\x85\xa0\u1680\u2003\x1c\x1f\x0b\u0301\u200b1٣中文🙂,.!|$_-") + [
    "'s", "'re", "   ", "the", "<|endoftext|>", "<|startoftext|>", "<|end", "\u3000", "ing ", " of the"]


def _texts(n=1500, seed=5):
    rng = random.Random(seed)
    lines = ["a line of words, plain.", "", "Ünïcode Wörter ǀǁ ǅ", "\n", "end 's it's", "x\x1cy \x1f z"]
    regular = ["\n".join(rng.choice(lines) for _ in range(rng.randint(1, 8))) for _ in range(200)]
    return ["", " ", "<|endoftext|>", "\n", "\n\n\n", "a\n\n\nb\n\n", "<|endoftext|> after\n<|startoftext|>\n"] + regular + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 200)))
                                         for _ in range(n)] + ["word " * 30000, "x" * 5000]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_give_the_library_ids(path):
    texts, tok = _texts(), Tokenizer.from_file(path)
    want = [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
    for limit in (1 << 27, 500_000):                         # the smaller one drops generations all the time
        pieces, got = Pieces(path, limit), []
        for k in range(0, len(texts), 200):
            got += [np.frombuffer(ids, "<u4").tolist() for ids in pieces.encode(texts[k:k + 200])]
            assert not any(len(p) > 64 for p in pieces.cache.young)
        assert got == want
    assert pieces.cache.old and pieces.encode([]) == [] and pieces.encode(["", ""]) == [b"", b""]


def test_generations_keep_what_is_met_again():
    cache, made = Generations(40 * ENTRY_BYTES), []
    for k in range(0, 400, 5):
        wanted = {f"new{i}" for i in range(k, k + 5)} | {"common"}
        lacking = cache.lacking(wanted)
        made += [x for x in lacking if x == "common"]
        cache.add(lacking, [x.upper() for x in lacking])
        assert all(cache.young[x] == x.upper() for x in wanted)
        assert len(cache.young) + len(cache.old) <= 60
    assert made == ["common"]


def test_chunks_give_the_library_ids_and_decoding():
    texts, tok = _texts(), Tokenizer.from_file(WORD)
    coder = chunk_bpe.ChunkCoder(WORD)
    for t in texts:
        ids = tok.encode(t, add_special_tokens=False).ids
        assert coder.encode(t) == ids and coder.decode(ids) == tok.decode(ids, skip_special_tokens=False)
        assert coder.ids_text(ids) == " ".join(map(str, ids))
    whole = coder.encode_all(texts)                                         # chunks known by now, texts together
    assert [np.frombuffer(b, "<u4").tolist() for b in whole] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    with pytest.raises(ValueError):
        chunk_bpe.ChunkCoder(BYTE)


def test_cuts_depend_on_content_alone():
    rng = random.Random(1)
    shared = "".join(rng.choice("abcdef ") for _ in range(4000))
    a, b = "prefix " + shared, "another longer beginning " + shared
    chunks = [{t[x:y] for x, y in zip([0, *chunk_bpe.cuts(t)], [*chunk_bpe.cuts(t), len(t)])} for t in (a, b)]
    assert len(chunks[0] & chunks[1]) >= len(chunks[0]) - 2 > 10


def test_token_counts_use_and_fill_the_cache(spark, scratch):
    texts = _texts(60) + [None, "same text", "same text"]
    docs = spark.createDataFrame(doc_rows(texts) + [(None, "same text", "", "", 0), (1, "", "", "", 0)], DOC_SCHEMA)
    tok, cache = Tokenizer.from_file(BYTE), scratch("cache")
    want = sorted((str(d.doc_id), len((d.text or "").encode()), len(tok.encode(d.text or "").ids)) for d in docs.collect())
    for part in (docs.where("doc_id % 2 = 0"), docs, docs):
        got = token_counts.token_counts(part, BYTE, cache, limit=50).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 50) for r in got)
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("content").distinct().count() == len({d.text or "" for d in docs.collect()})
    # stored counts are what is used
    other = scratch("cache")
    stored.selectExpr("content", "version", "n_tokens + 1000 AS n_tokens").write.parquet(other)
    again = token_counts.token_counts(docs, BYTE, other).collect()
    assert sorted((str(r.doc_id), r.n_tokens - 1000) for r in again) == sorted((i, n) for i, _, n in want)
    assert token_counts.token_counts(docs.limit(0), BYTE, scratch("cache")).count() == 0


def test_encode_decode_rows(spark):
    docs = spark.createDataFrame(doc_rows([None, "", "Hello world", "Hello world"]), DOC_SCHEMA)
    rows = {r.doc_id: (r.n_tokens, r.decoded) for r in chunk_bpe.encode_decode(docs, WORD).collect()}
    assert rows == {0: (0, ""), 1: (0, ""), 2: (2, "hello</w> world</w>"), 3: (2, "hello</w> world</w>")}
    assert chunk_bpe.encode_decode(docs.limit(0), WORD).count() == 0


def _histograms():
    rng = np.random.default_rng(4)
    return [{}, {1: 7}, {2048: 3}, {1025: 10}, {1024: 5}, dict(Counter(np.minimum(rng.lognormal(6, 1, 20000).astype(int) + 1, 2048).tolist())),
            dict(Counter(rng.integers(900, 1500, 3000).tolist())), {700: 10 ** 9, 648: 10 ** 9, 5: 3}]


@pytest.mark.parametrize("histogram", _histograms())
def test_plan_covers_the_histogram_and_is_tight(histogram):
    planned = packing.plan(histogram, 2048)
    used = Counter()
    for pattern, n in planned:
        assert n > 0 and sum(pattern) <= 2048
        for length in pattern:
            used[length] += n
    assert used == Counter(histogram)
    count = sum(n for _, n in planned)
    bound = max(-(-sum(k * n for k, n in histogram.items()) // 2048), sum(n for k, n in histogram.items() if k > 1024))
    assert count <= bound * 1.02 + 2


def test_packed_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_ROWS", 16)
    rng = random.Random(2)
    texts = [None, "", "a " * 30000] + [" ".join(rng.choice(["of", "the", "river", "ran"]) for _ in range(
        rng.choice([10, 10, 10, 50, 400, 900, 2047, 2048, 2049]))) for _ in range(200)]
    docs = spark.createDataFrame(doc_rows(texts) + [(5, "repeated id", "", "", 0), (None, "no id", "", "", 0)], DOC_SCHEMA)
    rows = packing.pack(docs, BYTE).collect()
    tok = Tokenizer.from_file(BYTE)
    want = []
    for d in docs.collect():
        ids = np.array(tok.encode(d.text or "").ids + [0], "<u4")
        start = 0
        for k, size in enumerate(packing.cut_lengths(len(ids), 2048)):
            want.append((d.doc_id, k, start, size, zlib.crc32(ids[start:start + size].tobytes())))
            start += size
    assert sorted(tuple(r[:5]) for r in rows if r.doc_id is not None) == sorted(w for w in want if w[0] is not None)
    assert len(rows) == len(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= -(-sum(w[3] for w in want) // 2048) + 2
    assert packing.pack(docs.limit(0), BYTE).count() == 0


def test_a_text_of_repeated_rows_is_encoded_once(spark, scratch, monkeypatch):
    rows = doc_rows(["one", "two", "two"]) + [(7, "the same row", "", "", 0)] * 200 + [(None, "no id", "", "", 0)] * 200
    docs, encoded, real = spark.createDataFrame(rows, DOC_SCHEMA).repartition(5), [], token_counts._encode

    def encode(texts, tokenizer):
        encoded.append(texts.select("_text"))
        return real(texts, tokenizer)

    monkeypatch.setattr(token_counts, "_encode", encode)
    got = token_counts.token_counts(docs, BYTE, scratch("cache")).collect()
    assert len(got) == 403 and all(r.n_tokens > 0 for r in got)
    assert sorted(r._text for df in encoded for r in df.collect()) == ["no id", "one", "the same row", "two"]


def test_a_text_of_20_mb(spark, scratch):
    """Whole, however long: the text repeats a passage that tokenizes alike wherever it stands."""
    passage = "".join(random.Random(9).choice("abc déf ghi, ") for _ in range(4000)).strip() + ".\n"
    repeats = 20_000_000 // len(passage)
    docs = spark.createDataFrame([(1, passage * repeats, 7)], "doc_id long, text string, _text int") \
        .withColumns({c: F.lit("x") for c in ("content", "n_tokens", "_row", "length", "block")})
    byte, word = (len(Tokenizer.from_file(p).encode(passage).ids) for p in (BYTE, WORD))
    assert token_counts.token_counts(docs, BYTE, scratch("cache")).first().n_tokens == byte * repeats
    made = chunk_bpe.encode_decode(docs, WORD).select("n_tokens", F.length("decoded").alias("n")).first()
    assert made.n_tokens == word * repeats and made.n > 20_000_000 // 2
    assert packing.pack(docs, BYTE).agg(F.sum("length")).first()[0] == byte * repeats + 1


def test_counts_where_one_row_repeats_and_ids_are_missing(spark, scratch):
    """A third of the rows are one row, a third have no id and one text; the cache holds other contents too."""
    cache, tok = scratch("cache"), Tokenizer.from_file(BYTE)
    token_counts.token_counts(spark.createDataFrame(doc_rows(["of another run", "plain 1"]), DOC_SCHEMA), BYTE, cache)
    rows = ([(7, "one row", "en", "a", None)] * 300 + [(None, "no id", "en", "a", None)] * 300
            + doc_rows([f"plain {k}" for k in range(300)], first=100))
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(6)
    got = token_counts.token_counts(docs, BYTE, cache)
    want = Counter((r[0], len(r[1].encode()), len(tok.encode(r[1], add_special_tokens=False).ids), False) for r in rows)
    assert Counter(map(tuple, got.collect())) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("content").distinct().count() == 303


def test_attach_spreads_a_key_of_many_rows(spark):
    """The rows of a key meet its value under many salts; keys without a value go."""
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("key"), "id",
                                    row_salt().alias("salt"))
    values = spark.range(2500).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"))
    got = attach(rows, values, ["key"])
    assert {(r.key, r.id, r.value) for r in got.collect()} == (
        {(0, k, 0) for k in range(2000)} | {(k, k, 2 * k) for k in range(2000, 2500)})
    assert got.count() == 2500 and got.where("key = 0").select("salt").distinct().count() > SALTS * 0.9
