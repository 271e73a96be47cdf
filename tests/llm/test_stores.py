"""Token store, packing, sharding, media, chat and URL filter against brute force and round trips."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat, media, packing, sharding, tokenstore, urlfilter

DOCS = "doc_id long, text string"
ODD = [(900, None), (901, ""), (902, " \t\n"), (904, "word " * 30_000), (905, "a b"), (905, "a b"), (None, "no id"), (906, "ﬁ Ω 漢字 \u0130 e\u0301 <|endoftext|>"), (907, "it's we'll  x\u00a0y\x1cz ² ½ DON'T")]
BYTE, WORD = bpe.tokenizer_path("byte_bpe_50k.json"), bpe.tokenizer_path("word_bpe_49k.json")


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=255), st.sampled_from("abc 'strelvmd\n\t09")), max_size=60))
def test_encoder_gives_the_librarys_ids(path, text):
    e = bpe.encoder(path)
    assert e.split is not None
    assert e.encode(text) == np.array(e.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_on_odd_texts(path):
    e = bpe.encoder(path)
    for _, text in ODD:
        assert e.encode(text or "") == np.array(e.tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("planes", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 1000, 20_000])
@pytest.mark.parametrize("top", [1, 300, 1 << 20, 1 << 32])
def test_planes_round_trip(planes, n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype("<u4")
    assert (tokenstore.unpack_ids(*tokenstore.pack_ids(ids, planes, 4096)) == ids).all()


def test_store_reads_back_every_document(spark):
    rng = random.Random(0)
    rows = [(k, " ".join(rng.choice(["alpha", "beta", "Gamma"]) for _ in range(rng.randint(0, 50)))) for k in range(200)] + ODD
    rng.shuffle(rows)
    store = tokenstore.write_store(spark.createDataFrame(rows, DOCS).repartition(5), BYTE, segment_ids=500)
    got = tokenstore.document_index(store).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for doc, text in ordered:
        ids = bpe.encoder(BYTE).encode(text or "") + bytes(4)
        want.append((doc, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert {r["doc_id"]: bytes(r["ids"]) for r in tokenstore.read_store(store).collect()}[906] == bpe.encoder(BYTE).encode(ODD[7][1]) + bytes(4)


def test_store_of_an_empty_table(spark):
    assert tokenstore.document_index(tokenstore.write_store(spark.createDataFrame([], DOCS), BYTE)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_plan_places_every_piece_once(histogram):
    slots = packing.plan(histogram, 64)
    filled, placed = {}, dict.fromkeys(histogram, 0)
    for s in slots:
        assert s.first == placed[s.length]
        placed[s.length] += s.count
        for k in range(s.count):
            filled.setdefault(s.sequence + k, []).append((s.offset, s.length))
    assert placed == histogram
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    rooms = []  # best-fit decreasing, piece by piece
    for length in sorted((k for k, v in histogram.items() for _ in range(v)), reverse=True):
        fit = min((room for room in rooms if room >= length), default=None)
        if fit is not None:
            rooms.remove(fit)
        rooms.append((64 if fit is None else fit) - length)
    assert set(filled) == set(range(len(filled))) and len(filled) == len(rooms)


def test_pack_is_whole_and_gapless(spark):
    rng = random.Random(4)
    rows = [(k, "one two three " * rng.randint(0, 400)) for k in range(120)] + ODD
    got = packing.pack(spark.createDataFrame(rows, DOCS).repartition(6), WORD, capacity=512).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, text in rows:
        ids = bpe.encoder(WORD).encode(text or "") + bytes(4)
        own = sorted(by_doc[doc], key=lambda r: r["piece"])
        if doc != 905:
            assert [(r["start"], r["length"], r["ids_crc32"]) for r in own] == [(k // 4, len(ids[k : k + 2048]) // 4, zlib.crc32(ids[k : k + 2048])) for k in range(0, len(ids), 2048)]
    assert len(by_doc[905]) == 2
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 512


def brute_capacity(sizes, shards):
    capacity = max(sizes)
    while True:
        used, room = 1, capacity
        for s in sizes:
            if s > room:
                used, room = used + 1, capacity
            room -= s
        if used <= shards:
            return capacity
        capacity += 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=25), st.integers(1, 8))
def test_cuts_keep_the_least_capacity(sizes, shards):
    array = np.array(sizes, np.int64)
    capacity = sharding.smallest_capacity(array, shards)
    assert capacity == brute_capacity(sizes, shards)
    bounds = [0, *sharding.cuts(array, shards), len(sizes)]
    assert bounds == sorted(bounds) and len(bounds) == shards + 1
    assert all(sum(sizes[a:b]) <= capacity for a, b in zip(bounds, bounds[1:], strict=False))


def test_shards_are_whole_even_and_keep_equal_texts(spark):
    rng = random.Random(6)
    rows = [(k, rng.choice(["", "x"]) + "abc " * rng.randint(1, 60)) for k in range(800)] + [(2000 + k, "the same " * 20) for k in range(300)] + ODD[:3]
    got = sharding.assign(spark.createDataFrame(rows, DOCS).repartition(7), 10).collect()
    texts, sizes, slots = dict(rows), {}, {}
    assert len(got) == len(rows)
    shard_of = {}
    for r in got:
        text = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 16, zlib.crc32(text))
        assert shard_of.setdefault(text, r["shard"]) == r["shard"]
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    hot = 300 * (len("the same " * 20) + 16)
    assert max(sizes.values()) <= 1.05 * max(hot, sum(sizes.values()) / 10)
    assert sharding.assign(spark.createDataFrame([], DOCS), 10).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=2000))
def test_png_round_trip(data):
    payload = media.padded(data)
    assert len(payload) % 192 == 0 and payload
    assert media.from_png(media.to_png(payload)) == payload
    assert len(media.feature(payload)) == 16


def test_damage_is_seen():
    stored = bytearray(media.to_png(media.padded(b"abc")))
    stored[45] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        media.from_png(bytes(stored))


def test_html_becomes_an_ordered_sequence():
    html = '<p>One &amp; two</p><img src="sha256:aa" alt="first"><script>no()</script><figure><img src="sha256:bb"><figcaption>second <b>one</b></figcaption></figure>tail<img src="other.png">'
    assert [(e["pos"], e["kind"], e["text"], e["digest"], e["caption"]) for e in media.parse_html(html)] == [
        (0, "text", "One & two", None, None), (1, "media", None, "aa", "first"), (2, "media", None, "bb", "second one"), (3, "text", "tail", None, None),
    ]
    assert media.parse_html(None) == [] == media.parse_html("")


def test_digests_resolve_in_place(spark):
    pages = spark.createDataFrame([(1, '<p>a</p><img src="sha256:x"><p>b</p><img src="sha256:gone">'), (2, None)], "id long, html string")
    found = spark.createDataFrame([("x", 7)], "digest string, size long")
    got = {r["id"]: r["elements"] for r in media.resolve(media.interleaved(pages), found).collect()}
    assert [(e["pos"], e["kind"], e["media"] and e["media"]["size"]) for e in got[1]] == [(0, "text", None), (1, "media", 7), (2, "text", None), (3, "media", None)]
    assert got[2] == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a<b\\>"]), st.text(alphabet="ab\\<>/turn:\n#é", max_size=20)), max_size=6))
def test_template_is_reversible(turns):
    formatted, spans = chat.format_turns(turns)
    assert chat.parse(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def brute_paths(nodes):
    parent = {(t, n): p for t, n, p, _ in nodes}
    score = {(t, n): s or 0.0 for t, n, _, s in nodes}
    inner = {(t, p) for t, n, p, _ in nodes if (t, p) in parent}
    out = {}
    for t, n, _, _ in nodes:
        if (t, n) in inner:
            continue
        path, at = [], n
        while at is not None and (t, at) in parent and at not in path:
            path.append(at)
            at = parent[t, at]
        if at is None or (t, at) not in parent:
            out[t, n] = (path[::-1], sum(score[t, k] for k in path) / len(path))
    return out


def test_branches_match_brute_force(spark):
    rng = random.Random(9)
    nodes = [(t, n, None if n == 0 else rng.randrange(n), rng.choice([None, rng.random()])) for t in range(6) for n in range(rng.randint(1, 40))]
    nodes += [(50, n, n - 1 if n else None, 1.0) for n in range(130)]  # a deep chain
    nodes += [(60, 1, 2, 0.0), (60, 2, 1, 0.0), (60, 3, 2, 0.0), (61, 5, 99, 0.5)]  # a cycle with a tail, an orphan
    got = chat.rank_branches(spark.createDataFrame(nodes, "tree long, node long, parent long, score double")).collect()
    want = brute_paths(nodes)
    assert {(r["tree"], r["leaf"]): list(r["path"]) for r in got} == {k: p for k, (p, _) in want.items()}
    for t in {t for t, _ in want}:
        order = [r["leaf"] for r in sorted((r for r in got if r["tree"] == t), key=lambda r: r["branch_rank"])]
        assert order == [leaf for _, leaf in sorted((-round(s, 12), leaf) for (tree, leaf), (_, s) in want.items() if tree == t)]


def test_hosts_paths_and_rules(spark):
    urls = [None, "", "no scheme", "http://A.Example.NET/en/x?q#f", "https://example.org", "x://org/fr/", "x://myorg/fr/", "x://a.org/fr?/", "http://h/p://q", "x://sub.example.com/de/1#/en/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    host, path = urlfilter.host_and_path(F.col("url"))
    got = df.select("page_id", host.alias("host"), path.alias("path"))
    text, verdict = urlfilter.ruled(F.col("host"), F.col("path"), urlfilter.RULES)
    rows = [tuple(r) for r in got.select("page_id", "host", "path", text.alias("r"), verdict.alias("v")).orderBy("page_id").collect()]
    assert rows == [
        (0, "", "", None, None), (1, "", "", None, None), (2, "", "", None, None), (3, "a.example.net", "/en/x", "example.net/en/", "allow"), (4, "example.org", "", None, None),
        (5, "org", "/fr/", "org/fr/", "allow"), (6, "myorg", "/fr/", None, None), (7, "a.org", "/fr", None, None), (8, "h", "/p://q", None, None), (9, "sub.example.com", "/de/1", "example.com/de/", "block"),
    ]


def test_judge_tells_urls_apart_and_survives_odd_tables(spark):
    rng = random.Random(1)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(3, 8)))
    good = [f"http://{word('aeinrst')}.example.net/en/{word('aeinrst')}" for _ in range(60)]
    bad = [f"http://{word('xqzkvw')}.net/{word('xqzkvw')}" for _ in range(60)]
    more = ["http://rates.example.org/en/stain", "http://xqzzk.example.org/wvqx"]
    df = spark.createDataFrame([(k, u, "extra") for k, u in enumerate([*good, *bad, *more, None, "", more[0]])], "page_id long, url string, host string")
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(df).collect()}
    assert len(got) == 125 and got[120] == "allow" == got[124] and got[121] == "block"
    assert urlfilter.judge(df.limit(0)).collect() == []
    assert {r["verdict"] for r in urlfilter.judge(df.filter("page_id >= 120")).collect()} == {"allow"}
