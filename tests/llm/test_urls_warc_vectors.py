import hashlib
import io
import math
import os
import random
import uuid

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from logtide.llm import embedding_dedup, queries, url_filter, warc
from tests.llm.helpers import least_components

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def test_url_rules_and_list(spark):
    urls = [None, "", "no scheme", "://", "http://", "http://COM/", "http://com", "http://a.Example.com/en/x",
            "https://www.example.com/en/?q", "https://x.www.example.com/en/y#z", "https://notexample.com/en/a",
            "http://a.net/es/1", "http://a.net/fr/", "http://a.net/de/7?utm_source=feed", "http://a.net/de/7/#top",
            "https://a.net/de/7.html", "http://a.net/de/8", "http://a.net?ref=x&b=1&a=2", "ftp://a.net?a=2&b=1",
            "http://a.net?a=2", "x://y://z/p?q?r#s"]
    rows = [(i, u, "h") for i, u in enumerate(urls)] + [(13, urls[13], "h"), (None, urls[13], None)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("host", F.lit(1)).withColumn("block", F.lit(1))
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, queries.URL_RULES).collect()]
    assert len(got) == len(rows)
    by_id = {g[0]: g[1:] for g in got}
    assert by_id[0] == by_id[2] == by_id[3] == by_id[4] == ("", "", None, "allow")
    assert by_id[5] == ("com", "/", "com/", "allow") and by_id[6] == ("com", "", None, "allow")
    assert by_id[7] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert by_id[8][2:] == by_id[9][2:] == ("www.example.com/en/", "allow")
    assert by_id[10][2:] == ("com/", "allow")
    assert by_id[11][2:] == ("net/es/", "block") and by_id[12][2:] == ("net/fr/", "block")
    assert [by_id[i][3] for i in (13, 14, 15, 16)] == ["block", "block", "block", "allow"]
    assert [by_id[i][3] for i in (17, 18, 19)] == ["block", "block", "allow"]
    assert by_id[20][:2] == ("y:", "//z/p")
    assert url_filter.judge_urls(pages.limit(0), queries.URL_RULES).count() == 0


@pytest.mark.parametrize("blocks", [1, 64])
def test_full_filter_changes_no_result(spark, blocks):
    rows = spark.range(3000).select(F.concat(F.lit("u"), F.col("id") % 700).alias("k"), "id")
    listed = spark.range(0, 900, 3).select(F.concat(F.lit("u"), "id").alias("k")).union(spark.sql("SELECT CAST(NULL AS STRING)"))
    got = url_filter.listed_rows(rows, listed, "k", blocks=blocks).collect()
    assert len(got) == 3000 and all(r.listed == (int(r.k[1:]) % 3 == 0) for r in got)
    assert all(r.possible for r in got if r.listed)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "embeddings", "documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(queries.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(str, (tuple(r) for r in got.select(cols).collect()))) == sorted(map(str, want.fetchall()))


def test_archives_are_read_in_parallel(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    rows = [(i, "u", f"payload {i} " * 50) for i in range(400)]
    folder = scratch("warc")
    manifest = warc.write_warc(spark.createDataFrame(rows, PAGES).repartition(4), folder)
    files = manifest.count()
    assert files >= 20
    back = warc.read_warc(manifest, folder)
    used = back.withColumn("p", F.spark_partition_id()).select("p").distinct().count()
    assert back.count() == 400 and used >= files // 3


def test_warc_round_trip(spark, scratch):
    big, other = "p" * 1000, "é" * 700
    rows = [(1, "http://a/", big), (2, None, big), (5, "http://c/?q=a b\u00e9", big), (3, "u", other), (4, "u", other),
            (6, "u", "small"), (7, "u", "small"), (8, "u", None), (9, "u", ""), (10, "u", "x" * 3_000_000),
            (11, "u", "a\r\n\r\nb"), (None, "u", big), (12, "u", "WARC/1.1\r\n" * 200)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit(0))
    folder = scratch("warc")
    manifest = warc.write_warc(pages, folder)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)
    got = warc.read_warc(manifest, folder, with_payload=True).collect()
    want = []
    for i, url, html in rows:
        data = (html or "").encode()
        ref = {1: "5", 2: "5", 3: "4"}.get(i)
        want.append((None if i is None else str(i), url, "revisit" if ref else "response", len(data),
                     hashlib.sha1(data).hexdigest(), ref, None if ref else data))
    plain = [tuple(bytes(v) if isinstance(v, (bytes, bytearray)) else v for v in r) for r in got]
    assert sorted(plain, key=str) == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_members_and_damage():
    records = [warc.record("response", str(i), "http://u/", bytes([i % 250]) * (i * 4000), hashlib.sha1(
        bytes([i % 250]) * (i * 4000)).hexdigest(), None) for i in range(60)]
    archive = b"".join(map(warc.gzip_member, records))
    assert [len(p) for _, _, p in warc.read_records(io.BytesIO(archive))] == [i * 4000 for i in range(60)]
    with pytest.raises(warc.BadRecord):
        list(warc.read_records(io.BytesIO(archive[:-9])))
    for damaged in (records[3].replace(b"\x03\x03", b"\x03\x04", 1), records[3][:-2], records[3] + b"x"):
        with pytest.raises(warc.BadRecord):
            list(warc.read_records(io.BytesIO(warc.gzip_member(damaged))))


def _cosine_links(vectors):
    good = {}
    for i, v in enumerate(vectors):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = v
    links = set()
    for i, v in good.items():
        for j, w in good.items():
            if i < j and len(v) == len(w):
                dot = sum(a * b for a, b in zip(v, w))
                if dot / (math.sqrt(sum(a * a for a in v)) * math.sqrt(sum(b * b for b in w))) >= 0.95:
                    links.add((i, j))
    return links


@pytest.mark.parametrize("tile,leading", [(2048, 1), (8, 1), (4, 3)])
def test_vector_links_match_brute_force(spark, monkeypatch, tile, leading):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    monkeypatch.setattr(embedding_dedup, "_leading", lambda rows: leading)
    rng = random.Random(tile)
    vectors = [None, [], [0.0] * 20, [1.0, None] + [0.0] * 18, [float("nan")] * 20, [float("inf")] + [1.0] * 19,
               [1.0, 2.0], [2.0, 4.0], [-0.0, 1.0], [0.0, 1.0], [5.0], [-3.0], [1e200] * 20, [1e-200] * 20]
    for _ in range(25):
        base = [rng.gauss(0, 1) for _ in range(20)]
        vectors += [base, [2 * x for x in base], list(base)]
        vectors += [[x + rng.gauss(0, s) for x in base] for s in (0.05, 0.2, 0.3, 0.33, 0.4)]
    rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>") \
        .withColumn("label", F.lit(1)).withColumn("cell", F.lit(1)).withColumn("group", F.lit("g"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.embedding_links(rows).collect()}
    links = _cosine_links([None if v in ([1e200] * 20, [1e-200] * 20) else v for v in vectors])
    links |= {(12, 13)}                  # out of the brute force's range: the same direction
    ones = [i for i, v in enumerate(vectors) if v and len(v) == 20 and i not in (2, 3, 4, 5, 12, 13)]
    for i in ones:
        v = vectors[i]
        if sum(v) / (math.sqrt(20) * math.sqrt(sum(x * x for x in v))) >= 0.95:
            links |= {(12, i), (13, i)}
    root = least_components(range(len(vectors)), links)
    n = [sum(i in e for e in links) for i in range(len(vectors))]
    assert got == {i: (n[i], root[i], root[i] == i) for i in range(len(vectors))}


def test_vectors_in_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert embedding_dedup.embedding_links(spark.createDataFrame([], schema)).count() == 0
    rows = spark.createDataFrame([(1, None), (None, None), (2, [0.0])], schema)
    assert sorted(str(tuple(r)) for r in embedding_dedup.embedding_links(rows).collect()) == sorted(
        ["(1, 0, 1, True)", "(2, 0, 2, True)", "(None, 0, None, False)"])
    rows = spark.createDataFrame([(4, [1.0, 1.0])] * 2 + [(None, [1.0, 1.0]), (9, [2.0, 2.0])], schema)
    assert sorted(str(tuple(r)) for r in embedding_dedup.embedding_links(rows).collect()) == sorted(
        ["(4, 3, 4, True)"] * 2 + ["(None, 3, None, False)", "(9, 3, 4, False)"])


def _links_of(x):
    """(n_links, component_id, kept) per row of a matrix, by all products."""
    unit = x.astype(np.float64) / np.sqrt((x.astype(np.float64) ** 2).sum(1))[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    root = least_components(range(len(x)), zip(*(e.tolist() for e in np.nonzero(linked))))
    return {i: (int(n), root[i], root[i] == i) for i, n in enumerate(linked.sum(1).tolist())}


def _vector_rows(spark, x):
    return spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>").repartition(4)


def test_vectors_are_dealt_in_proportion_to_their_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(embedding_dedup, "TILE", 64)
    real, folder = embedding_dedup.map_arrow, str(tmp_path)

    def counted(df, fn, schema):
        def run(batches):
            seen = []

            def passed():
                for b in batches:
                    seen.append(b.nbytes)
                    yield b

            yield from fn(passed())
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                f.write(str(sum(seen)))

        return real(df, run, schema)

    monkeypatch.setattr(embedding_dedup, "map_arrow", counted)
    x = np.random.default_rng(3).standard_normal((4000, 16)).astype(np.float32)
    x[3900:] = 2 * x[:100] + 0.1 * x[200:300]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.embedding_links(_vector_rows(spark, x)).collect()}
    assert got == _links_of(x)
    assert sum(int(f.read_text()) for f in tmp_path.iterdir()) < 40 * x.nbytes


def test_crowded_buckets_and_parts_meet_pairwise(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 64)
    monkeypatch.setattr(embedding_dedup, "SPLIT", 16)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    x[:600] = x[0] + 0.2 * rng.standard_normal((600, 16)).astype(np.float32)      # links, many of them at the threshold
    real, found = embedding_dedup._crowded, []
    monkeypatch.setattr(embedding_dedup, "_crowded", lambda *a: found.append(real(*a)) or found[-1])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.embedding_links(_vector_rows(spark, x)).collect()}
    assert got == _links_of(x)
    assert max(found[0].values()) > 2


@pytest.mark.parametrize("parts", [1, 2, 5, 6])
def test_each_pair_of_parts_is_dealt_once(spark, parts):
    members = spark.createDataFrame([(p, 1, 2, bytearray(8), 0, p, parts) for p in range(parts)],
                                    "group long, weight long, dim int, vector binary, cell long, part int, parts int")
    tiles = {}
    for lo in range(parts // 2 + 1):
        for r in embedding_dedup._dealt(members, lo, lo + 1).collect():
            tiles.setdefault((lo, r.tile), []).append(r.group)
    pairs = sorted(tuple(sorted(g)) for g in tiles.values())
    assert pairs == sorted([(p,) for p in range(parts)] + [(p, q) for p in range(parts) for q in range(p + 1, parts)])


@pytest.mark.parametrize("alone", [True, False])
def test_tile_links_match_all_products(alone):
    rng = np.random.default_rng(5)
    x = np.concatenate([[1.0] * 12 + s * rng.standard_normal((60, 12)) for s in (0.05, 0.2, 0.4, 2.0)])
    weight, left = rng.integers(1, 4, len(x)), rng.random(len(x)) < 0.5
    turn = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    links, root = embedding_dedup.tile_links(x, turn, weight, left, alone, 0.95)
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    counted = linked if alone else linked & (left[:, None] != left[None, :])
    assert links.tolist() == (counted @ weight).tolist()
    ends = np.nonzero(counted)
    assert (root[ends[0]] == root[ends[1]]).all()
    whole = least_components(range(len(x)), zip(*(e.tolist() for e in np.nonzero(linked))))
    assert all(whole[i] == whole[r] for i, r in enumerate(root.tolist()))


def test_a_link_is_found_by_some_trial_but_for_the_stated_odds():
    for threshold, leading in ((0.95, 0), (0.95, 7), (0.7, 3)):
        trials, bits, apart = embedding_dedup.trial_plan(threshold, leading, 64)
        same = 1 - math.acos(threshold) / math.pi
        rest = embedding_dedup.TABLES * embedding_dedup.BITS - bits
        stray = sum(math.comb(rest, k) * (1 - same) ** k * same ** (rest - k) for k in range(apart + 1, rest + 1))
        assert stray <= embedding_dedup.STRAY
        once = same ** leading * (1 - (1 - same ** bits) ** embedding_dedup.TABLES) * (1 - stray)
        assert (1 - once) ** trials <= embedding_dedup.MISS
