"""The operators over small tables: SQL oracles, odd rows, brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re
import struct
import zlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import xxhash
from oracle_harness import compare, duck
from pyspark.sql import functions as F

import corpus_pipeline
from sparkload.llm import binary_output, bpe, fingerprints, license_scan, minhash, mixing, quality_rules, token_counts, toxicity, url_filters
from sparkload.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns of other tables' kinds, to clash with names that operators use.
CLASH = ["size", "words", "kept", "host", "digest", "row", "part", "id", "component", "mix_copies", "target", "score", "n"]
rnd = random.Random(9)
WORDS = ["the", "river", "Stone", "green", "house", "of", "under", "mit", "license", "ÄRGER", "été", "🙂", "run."]
BASE = " ".join(rnd.choices(WORDS, k=300))
ROWS = [
    (0, BASE, "a"), (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one", None), (5, BASE, "b"),
    (6, BASE + " and some more", "b"), (7, " ".join(rnd.choices(WORDS, k=20_000)), "b"), (8, "# $ % x\nx\nx\n<a> Released under the MIT license!", "c"),
    (9, license_scan.TEMPLATES[0][0].upper(), "c"), (10, "x " * 40, "c"), (11, "line one here\n" * 3 + " ".join(WORDS * 3), None),
]
ODD = [(12, BASE, "a"), (12, BASE, "a"), (None, "a text without an id, of its own", "a"), (None, None, None)]


def frame(spark, rows, clash=True):
    df = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASH}) if clash else df


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """documents.parquet with odd rows, and an empty one."""
    root = str(tmp_path_factory.mktemp("llm"))
    frame(spark, ROWS + ODD, False).write.parquet(f"{root}/odd/documents.parquet")
    frame(spark, ROWS, False).write.parquet(f"{root}/plain/documents.parquet")
    frame(spark, [], False).write.parquet(f"{root}/empty/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{root}/empty/labels.parquet")
    pages = [(1, "http://www.Example.com/en/x?q", '<a href="//bad.net/es/">x</a> <A HREF=\'http://ok.com/a\'>'), (2, "https://bad.net/fr/1", None), (3, None, "href="),
             (4, "no scheme", ""), (5, "http://bad.net", '<a href="/own">'), (6, "x://example.com/en/#f", '<a href="http://www.example.com/">'), (6, "x://example.com/en/#f", ""),
             (None, "ftp://a.org/?x://y.com/", '<a href="http://bad.net/fr/2"><a href="http://bad.net/fr/2">')]
    schema = "page_id long, url string, html string"
    spark.createDataFrame(pages, schema).withColumns({c: F.lit("clash") for c in ("host", "rule", "rank", "kind")}).write.parquet(f"{root}/odd/pages.parquet")
    spark.createDataFrame([], schema).write.parquet(f"{root}/empty/pages.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{root}/empty/embeddings.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{root}/empty/benchmark.parquet")
    return root


def small_duck(path):
    con = duckdb.connect()
    for t in os.listdir(path):
        con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}/{t}/*.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(QUERIES[name](spark, SF), duck(SF), ORACLES[name])
    assert ok, msg


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_odd_rows_match_oracle(spark, folder, name):
    path = f"{folder}/{'plain' if name == 'op9_minhash' else 'odd'}"  # its SQL gives a row per id
    ok, msg = compare(QUERIES[name](spark, path), small_duck(path), ORACLES[name])
    assert ok, msg


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, folder, name):
    out = QUERIES[name](spark, f"{folder}/empty")
    assert out.count() == 0


def test_clashing_columns(spark, folder):
    docs, scratch = frame(spark, ROWS + ODD), f"{folder}/cache"
    n = len(ROWS + ODD)
    path = public_tokenizers.path("word_bpe_49k.json")
    outs = [token_counts.token_counts(spark, docs, path, scratch), quality_rules.quality(spark, docs), mixing.mix(spark, docs),
            bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json")), fingerprints.with_next(spark, docs), license_scan.scan(spark, docs),
            minhash.groups(spark, docs), toxicity.toxicity(spark, docs, docs.select("doc_id", F.lit(0).alias("toxic")))]
    assert [o.count() for o in outs] == [n] * len(outs)
    for kept in (quality_rules.clean(spark, docs), minhash.dedup(spark, docs), mixing.emit(mixing.mix(spark, docs))):
        assert set(kept.columns) >= {"doc_id", "text", "source", "n_chars", "size"} and kept.count() > 0


def test_token_counts_and_cache(spark, folder):
    path, cache = public_tokenizers.path("word_bpe_49k.json"), f"{folder}/counts"
    library = token_counts.load(path)
    docs = frame(spark, ROWS + ODD)
    want = sorted((i if i is not None else -1, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t, _ in ROWS + ODD)
    rows = lambda: sorted((r[0] if r[0] is not None else -1, r[1], r[2]) for r in token_counts.token_counts(spark, docs, path, cache).collect())
    assert rows() == want
    stored = spark.read.parquet(cache)
    n = stored.count()
    assert n == stored.select("digest").distinct().count() < len(want)  # each content once
    assert rows() == want and spark.read.parquet(cache).count() == n  # nothing is encoded again
    stored.limit(1).write.mode("append").parquet(cache)  # as two runs at a time may leave it
    assert rows() == want
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert token_counts.version_digest(other) != token_counts.version_digest(path)


def test_bpe_digests(spark):
    library = token_counts.load(public_tokenizers.path("byte_bpe_50k.json"))
    out = bpe.encode_documents(frame(spark, ROWS), public_tokenizers.path("byte_bpe_50k.json"), with_ids=True).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r, (i, t, _) in zip(sorted(out), ROWS):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert (r.doc_id, r.n_tokens, list(r.ids), r.ids_sha256, r.decoded_sha256) == (i, len(ids), ids, sha(",".join(map(str, ids))), sha(t or ""))


def test_records_round_trip(spark, folder):
    library = token_counts.load(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [*ROWS, *ODD]
    rnd.shuffle(rows)
    manifest = binary_output.write_records(spark, frame(spark, rows), public_tokenizers.path("byte_bpe_50k.json"), f"{folder}/rec", file_bytes=5000)
    out = binary_output.read_records(manifest, f"{folder}/rec").orderBy("start").collect()
    start = 0
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for r, (i, t, _) in zip(out, ordered, strict=True):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        assert tuple(r) == (i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    name = manifest.where("n_records > 1").first().path  # the index leads to any document
    at = struct.unpack("<qqq", open(f"{folder}/rec/{name}.idx", "rb").read()[24:48])
    with open(f"{folder}/rec/{name}.rec", "rb") as f:
        f.seek(at[1])
        assert len(binary_output.read_frame(f)) == at[2]
    with open(f"{folder}/rec/{name}.rec", "r+b") as f:
        f.seek(30)
        f.write(b"\xff\xfe\xfd")
    with pytest.raises(Exception, match="damaged|differ"):
        binary_output.read_records(manifest, f"{folder}/rec").count()


def test_records_of_a_hot_id_are_split(spark, folder):
    r = random.Random(6)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"{r.randrange(10**9)} text", None) for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = binary_output.write_records(spark, frame(spark, rows).repartition(6), public_tokenizers.path("byte_bpe_50k.json"), f"{folder}/hot")
        assert manifest.agg(F.max("n_records")).first()[0] < 800
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    out = binary_output.read_records(manifest, f"{folder}/hot").orderBy("start").collect()
    assert [x.doc_id for x in out] == sorted((i for i, *_ in rows), key=lambda i: (i is not None, i or 0))


def plain_anchors(text):
    x = lambda data, seed: xxhash.xxh64_intdigest(data, seed)
    pair = lambda a, b: x(struct.pack("<Q", b), x(struct.pack("<Q", a), 42))
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    h = [x(w, 42) for w in text.encode().lower().split()]
    p = [pair(a, b) for a, b in zip(h, h[1:])]
    out = [pair(x, y) & 0xFFFFFFFF for x, y in zip(p, p[1:])] if len(h) < 64 else []
    for i in range(len(p) - 7 if len(h) >= 32 else 0):
        if min(p[i:i + 8], key=signed) in (p[i], p[i + 7]):
            eight = pair(pair(p[i], p[i + 2]), pair(p[i + 4], p[i + 6]))
            out.append(pair(eight, p[i + 7]) & 0xFFFFFFFF)
    if not out:
        whole = 42
        for v in h:
            whole = x(struct.pack("<Q", v), whole)
        out = [whole & 0xFFFFFFFF]
    return out


def plain_likeness(a, b):
    a, b = list(dict.fromkeys(a)), list(dict.fromkeys(b))
    ours, theirs = [x for x in a if x in b], [y for y in b if y in a]
    same = len(set(zip(ours, ours[1:])) & set(zip(theirs, theirs[1:]))) + bool(ours)
    return 2 * same / (len(a) + len(b))


def test_likeness_of_short_and_moved_texts(spark):
    r = random.Random(12)
    word = lambda: f"w{r.randrange(10**6)}"
    pairs = []
    for n in [*range(5, 60)] * 2:  # short texts with a new second half
        a = [word() for _ in range(n)]
        pairs.append(("half", " ".join(a), " ".join(a[:n - n // 2] + [word() for _ in range(n // 2)])))
    for n in (10, 40, 300):  # a passage moved as a whole
        a = [word() for _ in range(n)]
        pairs.append(("moved", " ".join(a), " ".join(a[n // 2:] + a[:n // 2])))
        pairs.append(("other", " ".join(a), " ".join(word() for _ in range(n))))
        pairs.append(("equal", " ".join(a), " ".join(a)))
    df = spark.createDataFrame(pairs, "kind string, a string, b string")
    df = fingerprints.with_anchors(fingerprints.with_anchors(df, "a", "x"), "b", "y")
    got: dict = {}
    for row in df.select("kind", "a", "b", fingerprints.likeness(F.col("x"), F.col("y")).alias("l")).collect():
        assert abs(row.l - plain_likeness(plain_anchors(row.a), plain_anchors(row.b))) < 1e-9
        got.setdefault(row.kind, []).append(row.l)
    half = sorted(got["half"])
    assert half[0] > 0 and 0.3 < half[len(half) // 2] < 0.6
    assert min(got["moved"]) > 0.5 and max(got["other"]) == 0 and set(got["equal"]) == {1.0}


@pytest.mark.parametrize("range_rows", [1000, 2])
def test_fingerprints_brute_force(spark, folder, range_rows, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(fingerprints.with_next, "__defaults__", (range_rows,))
    rows = sorted(((i, t or "") for i, t, _ in ROWS + ODD), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = fingerprints.op5(spark, f"{folder}/odd").collect()
    want = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        a, e, b = plain_anchors(t), plain_anchors(edited), plain_anchors(after)
        digits = lambda xs: "".join(f"{x:08x}" for x in xs)
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), digits(a), digits(e), round(plain_likeness(a, e), 9), round(plain_likeness(a, b), 9)))
    got = [(*r[:5], round(r[5], 9), round(r[6], 9)) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_url_host_and_path(spark):
    urls = {"http://A.Com/x?y": ("a.com", "/x"), "x": ("", ""), None: ("", ""), "a://b": ("b", ""), "a://B#c/d": ("b", ""), "a://b://c": ("b:", "//c"), "a://É.com/É": ("É.com", "/É")}
    host, path = url_filters.host_path(F.col("u"))
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", host, path).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == urls


def test_distrust_flows_backwards(spark):
    pages = spark.createDataFrame([(1, "http://good.com/", '<a href="http://friend.org/x">'), (2, "http://friend.org/", ""), (3, "http://bad.net/es/", ""), (4, "http://fan.org/", '<a href="http://bad.net/">')],
                                  "page_id long, url string, html string")
    out = {r.host: r for r in url_filters.filter_urls(spark, pages).collect()}
    assert out["friend.org"].trust > 0 and out["friend.org"].verdict == "allow"
    assert out["fan.org"].distrust > 0 and out["fan.org"].verdict == "block" and out["fan.org"].rule is None


def test_ranks_of_a_long_chain_are_converged(spark):
    """Hosts 1 to 14 links from a blocked one, against ranks that are iterated
    until they stand still."""
    links = {f"h{i}.org": [f"h{i - 1}.org" if i > 1 else "bad.net"] for i in range(1, 15)}
    links |= {"bad.net": [], "good.com": ["friend.org", "h1.org"], "friend.org": []}
    path = {"bad.net": "es/"}
    pages = [(i, f"http://{h}/{path.get(h, '')}", "".join(f'<a href="http://{t}/">' for t in to)) for i, (h, to) in enumerate(links.items())]
    out = {r.host: r for r in url_filters.filter_urls(spark, spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    back = {h: [f for f, to in links.items() if h in to] for h in links}

    def converged(seed, edges):
        rank = dict.fromkeys(edges, 0.0)
        for _ in range(2000):
            new = {h: (1 - url_filters.FOLLOW) * (h == seed) for h in edges}
            for h, to in edges.items():
                for t in to:
                    new[t] += url_filters.FOLLOW * rank[h] / len(to)
            rank = new
        return rank

    trust, distrust = converged("good.com", links), converged("bad.net", back)
    for h in links:
        assert abs(out[h].trust - trust[h]) < 1e-9 and abs(out[h].distrust - distrust[h]) < 1e-9
        want = "block" if h == "bad.net" or (h != "good.com" and distrust[h] > max(trust[h], url_filters.LEAST)) else "allow"
        assert out[h].verdict == want
    assert {out[f"h{i}.org"].verdict for i in range(2, 15)} == {"block"} and out["h12.org"].rule is None


def test_url_verdicts_do_not_depend_on_the_size_of_the_table(spark):
    r = random.Random(8)
    hosts = [f"h{i}.org" for i in range(30)] + ["bad.net", "good.com", "worse.net", "fine.com"]
    path = {"bad.net": "es/", "worse.net": "fr/"}
    url = lambda h: f"http://{h}/{path.get(h, '')}"
    pages = [(h, url(h), "".join(f'<a href="http://{t}/">' for t in r.sample(hosts, 3))) for h in hosts]
    pages += [("bad.net", "http://bad.net/other", "")]
    more = [(f"s{i}.net", f"http://s{i}.net/es/", f'<a href="http://s{i + 1}.net/">') for i in range(200)]

    def verdicts(some):
        df = spark.createDataFrame([(k, u, x) for k, (_, u, x) in enumerate(some)], "page_id long, url string, html string")
        out = url_filters.filter_urls(spark, df, follow=0.5, tolerance=1e-6).collect()
        return {x.host: (x.verdict, round(x.trust, 5), round(x.distrust, 5)) for x in out if x.host in hosts and x.path == url(x.host).split(x.host)[1]}

    plain = verdicts(pages)
    assert {v for v, *_ in plain.values()} == {"allow", "block"} and any(v == "block" for h, (v, *_) in plain.items() if h.startswith("h"))
    assert verdicts(pages * 50) == plain == verdicts(pages + more)


def test_near_copies_in_crowded_buckets(spark):
    """Crowded buckets hold several components; links must equal brute force."""
    r = random.Random(11)
    rows = []
    for g in range(3):
        base = [f"w{r.randrange(400)}" for _ in range(60)]
        for _ in range(40):
            words = list(base)
            for _ in range(r.randrange(8)):
                words[r.randrange(60)] = f"v{r.randrange(1000)}"
            rows.append((len(rows), " ".join(words), "a"))
    r.shuffle(rows)
    sets = {i: set(zip(t.split(), t.split()[1:])) for i, t, _ in rows}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in rows:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert len(set(label.values())) > 6
    for small in (64, 2):
        out = {x.doc_id: x.component_id for x in minhash.groups(spark, frame(spark, rows), k=2, small=small).collect()}
        assert out == label


def test_dedup_leaves_one_row_of_each_group(spark):
    """Rows that repeat their group's smallest id, near copies of them, groups
    with null ids, and different texts under one id or none."""
    r = random.Random(5)
    a, b, c, d, e, f = (" ".join(f"w{r.randrange(5000)}" for _ in range(100)) for _ in range(6))
    rows = [(1, a, "a")] * 3 + [(7, a + " more", "a"), (None, a, "b")] + [(None, b, "a")] * 3 + [(None, c, "a"), (4, c, "b"), (None, c + " more", "a")]
    rows += [(9, d, "a"), (9, e, "a"), (2, e, "b"), (None, f, "a"), (None, None, "a"), (None, None, "a")]
    r.shuffle(rows)
    out = minhash.dedup(spark, frame(spark, rows).repartition(5)).collect()
    want = [(1, a), (None, b), (4, c), (9, d), (2, e), (None, f), (None, None), (None, None)]
    assert sorted(((x.doc_id, x.text) for x in out), key=str) == sorted(want, key=str)


def test_components_of_a_long_chain(spark):
    links = spark.range(1, 300).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    out = minhash.components(spark, links).collect()
    assert {tuple(r) for r in out} == {(i, 0) for i in range(300)}


def test_toxicity_on_held_out_rows(spark):
    """Rows whose label training never saw: 97 toxic and 728 others."""
    sf = "/root/testdata/sf0.1"
    out = toxicity.op10(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = out.join(labels, "doc_id").groupBy("held_out", "toxic", "predicted").count().collect()
    n = Counter({(r.held_out, r.toxic, r.predicted): r["count"] for r in rows})
    share = lambda held, toxic: n[held, toxic, 1] / (n[held, toxic, 0] + n[held, toxic, 1])
    print(n)
    assert share(True, 1) >= 0.8 and share(True, 0) <= 0.02
    assert share(False, 1) >= 0.9
    assert out.count() == 10_000 and out.where("held_out != (crc32(cast(doc_id as string)) % 5 = 0)").count() == 0


def test_toxic_sample_of_repeated_ids_and_of_one_label(spark):
    rows = [(1, "awful words here", "a")] * 200 + [(i, f"text number {i} of a quiet day", "a") for i in range(20, 60)]
    docs = frame(spark, rows).coalesce(1)
    labels = spark.createDataFrame([(r, int(r % 2)) for r in {i for i, *_ in rows} | set(range(1000, 1400))], "doc_id long, toxic int")
    p, share = toxicity.fit(spark, docs, labels, 15, 15)  # one id has more rows than twice the sample
    assert p is not None and share == 0.5
    assert toxicity.drop_toxic(spark, docs, labels.where("toxic = 1")).count() == len(rows)


def test_toxic_words_never_come_from_other_columns(spark):
    docs = frame(spark, [(i, f"text number {i} of a quiet day", "toxic" if i % 2 else "fine") for i in range(40)])
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    a = {r.doc_id: r.score for r in toxicity.toxicity(spark, docs, labels).collect()}
    b = {r.doc_id: r.score for r in toxicity.toxicity(spark, docs.withColumn("source", F.lit("x")).withColumn("lang", F.lit("y")), labels).collect()}
    assert a == b


def plain_clean(docs):
    """(id, text, source) of the rows that the quality rules keep."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    split = lambda s: re.findall(r"[^\x20\x09-\x0D]+", s)
    norm = lambda line: " ".join(split(line.translate(lower)))
    holders: dict = {}
    for k, (_, t, s) in enumerate(docs):
        own = {norm(x) for x in (t or "").split("\n") if len(split(x)) >= quality_rules.LINE_WORDS}
        order = sorted(own, key=lambda x: hashlib.md5(x.encode()).hexdigest())[:2]
        for x in own:
            holders.setdefault((s, x), set()).add(next((y for y in order if y != x), None))
    out = []
    for i, t, s in docs:
        t = t or ""
        words = split(t)
        windows = [tuple(words[j:j + 8]) for j in range(len(words) - 7)]
        seen = Counter(windows)
        repeated = {j + d for j, w in enumerate(windows) if seen[w] > 1 for d in range(8)}
        gone = lambda x, s=s: len(holders.get((s, norm(x)), ())) > quality_rules.LEAST
        left = "\n".join(x for x in t.split("\n") if not gone(x))
        if len(words) >= 20 and 100 * len(repeated) <= 30 * len(words) and len(split(left)) >= 0.3 * len(words):
            out.append((i, left, s))
    return out


def test_frequent_lines_of_a_large_host(spark):
    """One host, 4,000 different documents, a boilerplate line in 360 of them."""
    r = random.Random(3)
    prose = lambda n: " ".join(f"w{r.randrange(9999)}" for _ in range(n))
    line = "all Rights  reserved by the owners of this site"
    rows = [(i, f"{prose(30)}\n{line if i < 360 else prose(9)}\nread more\n{prose(15)}", "big") for i in range(4000)]
    rows += [(5000 + i, f"{prose(30)}\n{line}", "small") for i in range(quality_rules.LEAST)]
    copied = [prose(12) for _ in range(9)]
    rows += [(6000 + i, "\n".join([*copied[:i % 9], prose(12), *copied[i % 9:]]), "big") for i in range(100)]  # near copies
    rows += [(7000 + i, "\n".join(copied), "big") for i in range(100)]  # copies
    rows += [(8000, f"{line}\n" * 8 + "too few words are left", "big"), (8001, None, "big"), (8002, None, None)]
    docs = frame(spark, rows).repartition(7)
    out = {x.doc_id: x for x in quality_rules.clean(spark, docs).collect()}
    assert sorted((i, x.text, x.source) for i, x in out.items()) == sorted(plain_clean(rows))
    assert all(line not in out[i].text and "read more" in out[i].text for i in range(360))
    assert all(i in out and line in out[i].text for i in range(5000, 5000 + quality_rules.LEAST))
    assert all(i in out for i in [*range(4000), *range(6000, 6100), *range(7000, 7100)]) and 8000 not in out
    assert sum(len(out[i].text.split()) for i in range(7000, 7100)) == 100 * 108  # copies lose nothing
    assert all(x.n_chars == len(x.text) and x.host == "clash" for x in out.values())
    figures = {x.doc_id: x for x in quality_rules.quality(spark, docs).collect()}
    assert {i for i, x in figures.items() if x.kept} == set(out) and len(figures) == len({i for i, *_ in rows})


def test_pipeline_equals_a_plain_run(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    p, share = toxicity.fit(spark, spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    docs = [d for d, s in zip(docs, toxicity.score_texts(p, [d[1] for d in docs], share)) if s < 0.5]
    docs = plain_clean(docs)
    sets = {}
    for i, t, _ in docs:
        w = t.encode().lower().split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in range(len(sets)):
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    docs = [d for d in docs if label[d[0]] == d[0]]
    size = lambda t: len(t.encode().split())
    sources = sorted({s for *_, s in docs})
    words = {s: sum(size(t) for _, t, x in docs if x == s) for s in sources}
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(sources)}
    full: set = set()
    while True:
        level = (1.5 * sum(words.values()) - 2 * sum(words[s] for s in full)) / sum(w for s, w in weight.items() if s not in full)
        new = {s for s in sources if weight[s] * level > 2 * words[s]}
        if new == full:
            break
        full = new
    want = []
    library = token_counts.load(public_tokenizers.path("byte_bpe_50k.json"))
    for i, t, s in docs:
        rate = min(2.0 * words[s], weight[s] * level) / words[s]
        u = int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:13], 16) / 16**13
        ids = library.encode(t, add_special_tokens=False).ids
        want += [(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())] * (int(rate) + (u < rate - int(rate)))
    out = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in out.collect()) == sorted(want)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "minhash_near_dedup", "mixing", "bpe"]


def test_stages_keep_columns_and_take_odd_rows(spark, folder):
    docs = frame(spark, ROWS + ODD)
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, f"{folder}/odd")
        assert out.columns == docs.columns
    empty = spark.read.parquet(f"{folder}/empty/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, f"{folder}/empty")
        assert out.columns == empty.columns and out.count() == 0
