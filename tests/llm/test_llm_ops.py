"""The training-data operators against brute force, on small tables with nulls, ties, repeats and clashing columns."""

import math
import tracemalloc
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspan.llm import chat_format, language_id, lm_scoring, mixing, near_dedup, packing, quality_rules, registry, token_counts, url_filters
from loomspan.llm.attention import Adam, AttentionModel, Room, summed_rows
from loomspan.llm.fingerprints import fingerprint_edits
from loomspan.llm.pieces import PieceEncoder, cut

WORDS = "the of and to in is that for was with be as by are this".split()


def texts(n=60, seed=5):
    g = np.random.default_rng(seed)
    out = [" ".join(g.choice(WORDS, g.integers(3, 120))) for _ in range(n)]
    out[1], out[2], out[3] = None, "", "  \n\t "
    out[4] = out[5] = out[6]  # copies
    out[7] = "über  naïve x\n\n<|endoftext|> it's 12,5   done "
    out[8] = " ".join(g.choice(WORDS, 6000))  # long
    out[9] = out[8][:-4]  # a near copy
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, ["en", "de", None][k % 3], ["a", "b", None, "a"][k % 4], 1, 2, 3) for k, t in enumerate(texts())]
    return spark.createDataFrame([*rows, rows[10]], "doc_id long, text string, lang string, source string, kept int, n_tokens int, length int").cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="module")
def tokenizer():
    pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(registry.byte_bpe())


def test_pieces_are_exact(tokenizer):
    e = PieceEncoder.of(registry.byte_bpe())
    for t in [*texts(), "a  b", " a", "a ", "　 x", "x\x1c y", "don't 1 2", "\U0001f600 ok", "a\x85 b"]:
        want = tokenizer.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(e.encode(t or ""), "<u4").tolist() == want
        assert sum(e.count(p) for p in cut(t or "")) == len(want)


def test_packing_is_exact(docs, empty, tokenizer):
    got = packing.pack(docs, registry.byte_bpe(), window=64, end_id=0).collect()
    ids = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for k, t in enumerate(texts())}
    assert sum(r.length for r in got) == sum(map(len, ids.values())) + len(ids[10])
    fill = defaultdict(list)
    for r in got:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert list(r.ids) == piece and zlib.crc32(np.array(piece, "<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        fill[r.sequence_id].append((r.offset, r.length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(empty, registry.byte_bpe(), with_ids=False).count() == 0


def test_plan_uses_each_length_exactly():
    g = np.random.default_rng(1)
    counts = np.bincount(g.integers(1, 257, 20_000), minlength=257)
    used = np.zeros(257, int)
    sequences = 0
    for parts, times in packing.plan(counts, 256):
        assert sum(parts) <= 256
        sequences += times
        for p in parts:
            used[p] += times
    assert (used == counts).all() and sequences <= 1.01 * (counts * np.arange(257)).sum() / 256 + 1


def test_token_counts(docs, empty, tokenizer):
    for head in (0, 5, 1000):
        got = token_counts.count_tokens(docs, registry.byte_bpe(), limit=50, head=head).collect()
        assert len(got) == 61
        for r in got:
            t = texts()[r.doc_id] or ""
            n = len(tokenizer.encode(t, add_special_tokens=False).ids)
            assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(t.encode()), n > 50)
    assert token_counts.count_tokens(empty, registry.byte_bpe()).count() == 0


def brute_rules(t):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", t or "") if x]
    where = defaultdict(list)
    for i in range(len(w) - 4):
        where[tuple(w[i : i + 5])].append(i)
    cover = {i + k for p in where.values() if len(p) > 1 for i in p for k in range(5)}
    lines = [x for x in (t or "").split("\n") if __import__("re").search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover)


def test_quality_rules(docs, empty):
    got = quality_rules.judge(docs, drop_text=True).collect()
    assert len(got) == 61
    hosts = defaultdict(list)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_rules(texts()[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        hosts[r.source].append(r)
    n, f = len(got), sum(r.base_failed for r in got)
    mean = f / n
    spread = sum(sum(r.base_failed for r in h) ** 2 / len(h) for h in hosts.values()) / n - mean * mean
    k = min(max(mean * (1 - mean) / spread - 1, 1), 1000) if spread > 0 else 1000
    for h in hosts.values():
        rate = (sum(r.base_failed for r in h) + k * mean) / (len(h) + k)
        assert all(abs(r.host_rate - rate) < 1e-9 and r.kept == (not r.base_failed and rate <= 0.5) for r in h)
    assert quality_rules.judge(empty).count() == 0


def test_url_filters(spark):
    urls = ["https://www.Example.com/en/a", "https://x.example.com/en/", "https://a.net/es/1?x", "https://b.com", "https://b.com/", "no url", None, "https://c.org/q#z"] * 3
    got = url_filters.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), registry.URL_RULES).orderBy("page_id").collect()
    assert [r.rule for r in got][:8] == ["www.example.com/en/", "example.com/en/", "net/es/", None, "com/", None, None, None]
    assert [r.verdict for r in got][:3] == ["allow", "block", "block"] and got[0].host == "www.example.com" and got[3].path == "" and (got[5].host, got[5].path) == ("", "")
    assert {r.verdict for r in got} <= {"allow", "block"}
    assert url_filters.judge_urls(spark.createDataFrame([], "page_id long, url string"), registry.URL_RULES).count() == 0


def test_url_sample_is_of_distinct_urls(spark):
    urls = [f"https://a.net/{c}/{k}" for k in range(60) for c in ("es", "en")] + [f"https://b.com/{k}" for k in range(60)]
    t = spark.createDataFrame([(u,) for u in urls], "url string")
    hot = t.where("url like '%/es/%' or url like '%.com/%'").orderBy(F.xxhash64("url")).first().url  # fills a sample of rows
    rows = list(enumerate([*urls, *[hot] * 200]))
    got = url_filters.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), registry.URL_RULES, sample=100).collect()
    assert len({r.block_score for r in got}) > 1 and len(got) == len(rows)


def test_url_verdicts_by_brute_force(spark):
    """Features, suffix statistics without the own fold, sample and trees, each in plain Python."""
    g = np.random.default_rng(3)
    ends = ["com/", "net/es/", "net/fr/", "net/en/", "org/", "example.com/en/", "www.example.com/en/"]
    urls = [f"https://h{g.integers(9)}.{e}" + "".join(g.choice(list("ab1-/?&="), g.integers(1, 25))) for e in g.choice(ends, 400)]
    urls += urls[:50] + [None, "", "no url", "https://x.net/es/" + "y/" * 5000]
    t = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    t = t.select("*", F.xxhash64(F.coalesce("url", F.lit(""))).alias("hash"), F.lit("block").alias("label"), F.lit(1).alias("n"), F.lit("x").alias("host"))  # clashing names
    got = {r.page_id: r for r in url_filters.judge_urls(t, registry.URL_RULES, sample=120).collect()}
    hashes = {r.page_id: r.hash for r in t.select("page_id", "hash").collect()}
    seen, suffixes, of = {}, Counter(), defaultdict(list)
    for k, u in enumerate(urls):
        u, r = u or "", got[k]
        suffix, fold = r.host.rpartition(".")[2], hashes[k] % url_filters.FOLDS
        seen[k] = (u, r.host, r.path, suffix, fold, registry.URL_RULES.get(r.rule))
        suffixes[suffix] += 1
        if r.rule:
            of[suffix].append((fold, registry.URL_RULES[r.rule] == "block"))
    labels = [b for rows in of.values() for _, b in rows]
    prior = sum(labels) / len(labels)

    def rate(suffix, without=None):
        rows = [b for f, b in of[suffix] if f != without]
        return (sum(rows) + 10 * prior) / (len(rows) + 10)

    first = {}
    for k in sorted(seen, key=lambda k: (hashes[k], seen[k][0])):
        if seen[k][5] and seen[k][0] not in first:
            first[seen[k][0]] = seen[k]
    sample = list(first.values())[:120]
    x = np.array([url_filters.features(u, h, p, suffixes[s], rate(s, f)) for u, h, p, s, f, _ in sample])
    trees = url_filters.Trees().fit(x, np.array([v == "block" for *_, v in sample], float))
    score = trees.score(np.array([url_filters.features(u, h, p, suffixes[s], rate(s)) for u, h, p, s, _, _ in seen.values()]))
    assert len(got) == len(urls) and len(first) > 120
    for (k, row), b in zip(seen.items(), score, strict=True):
        assert got[k].block_score == pytest.approx(b, abs=1e-9)
        assert got[k].verdict == (row[5] or ("block" if b > 0.5 else "allow"))


def test_trees_learn():
    g = np.random.default_rng(0)
    x = g.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    t = url_filters.Trees().fit(x[:1500], y[:1500])
    assert ((t.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95
    assert url_filters.Trees().fit(x[:0], y[:0]).score(x[:2]).max() < 0.5


def test_cross_parsing_is_greedy():
    p = language_id.Parser({"a": "abracadabra", "b": "zzz"}, size=12, lane=1000)

    def brute(text, ref):
        n = i = 0
        while i < len(text):
            j = i + 1
            while j < len(text) and text[i : j + 1] in ref:
                j += 1
            n, i = n + 1, j
        return n

    for t in ("abra", "cadabracad", "zab", "brabra"):
        assert p.parse([t])[0].tolist() == [brute(t, "abracadabra"), brute(t, "zzz")]


def test_cross_parsing_of_many_letters():
    g = np.random.default_rng(9)
    han = [chr(0x4E00 + k) for k in range(400)]
    refs = {"a": "".join(g.choice(han, 600)), "b": "".join(g.choice(list("кдежзи語の한국abc "), 300)), "c": "日本語の 한국어 abra"}
    p = language_id.Parser(refs, size=6, lane=10_000)

    def brute(text, ref):
        n = i = 0
        while i < len(text):
            j = i + 1
            while j < len(text) and text[i : j + 1] in ref:
                j += 1
            n, i = n + 1, j
        return n

    texts = [refs["a"][50:90] + refs["b"][10:40], "日本語の한국 abracad", refs["a"][::7], "жжх語の", "x" + refs["b"][100:150]]
    assert p.parse(texts).tolist() == [[brute(t, refs[n]) for n in "abc"] for t in texts]


def test_language_id_of_other_scripts(spark):
    samples = {
        "en": "all people are born free and equal in dignity and rights they have reason and conscience",
        "ja": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられており",
        "ko": "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며",
        "zh": "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
    }
    rows = [("zh", "人人平等，自由和尊严，理性和良心"), ("ja", "人間は自由であり、平等である"), ("ko", "인간은 자유로우며 동등하다"), ("en", "people have equal rights")]
    got = language_id.identify(spark.createDataFrame(rows, "lang string, text string"), samples).collect()
    assert [r.lang_pred for r in got] == [r.lang for r in got]


def test_language_id(spark, small, empty):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    got = language_id.predict(docs).join(docs, "doc_id").where("held_out and length(text) > 100").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    odd = spark.createDataFrame([(1, None, "en"), (2, "123 !", "en"), (3, "the and", None)], "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in language_id.identify(odd, {"en": "the and of", "de": "und der"}).collect()} == {1: "und", 2: "und", 3: "en"}
    assert language_id.predict(empty).count() == 0


def brute_components(t, percent=85):
    sets = {}
    for k, x in t.items():
        w = (x or "").encode().lower().split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {k: k for k in t}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    keys = sorted(t)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in t}


def test_near_dedup(spark, docs, empty):
    g = np.random.default_rng(3)
    base = g.choice(10_000, 150).astype(str).tolist()
    t = dict(enumerate(texts()))
    for k in range(100, 160):  # a group whose members differ in up to 12 words: chains and near misses
        w = list(base)
        for at in g.integers(0, 150, g.integers(0, 12)):
            w[at] = f"x{g.integers(0, 10**6)}"
        t[k] = " ".join(w)
    got = near_dedup.near_duplicates(spark.createDataFrame(list(t.items()), "doc_id long, text string")).collect()
    want = brute_components(t)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert near_dedup.near_duplicates(docs).count() == 61
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_dedup_compares_in_proportion(spark):
    """Members of a large group that differ from all others by more than the limit meet nobody."""
    g = np.random.default_rng(5)
    counts = {}
    for n in (100, 300):
        base = g.choice(100_000, 400).astype(str)
        rows = []
        for k in range(n):
            w = base.copy()
            w[g.choice(400, int(g.integers(8, 14)), replace=False)] = [f"x{x}" for x in g.integers(0, 10**9, 20)][: 1]
            rows.append((k, near_dedup.shingles(" ".join(w)), 0))
        sets = spark.createDataFrame([(k, len(s), k, bytearray(s.tobytes())) for k, s, _ in rows], "id long, size long, root long, tokens binary")
        pairs = near_dedup.prefix_pairs(sets, n, 85).collect()
        counts[n] = len(pairs)
        found = {(min(r.a, r.b), max(r.a, r.b)) for r in pairs}
        for i in range(n):
            for j in range(i + 1, n):
                x, y = rows[i][1], rows[j][1]
                both = len(np.intersect1d(x, y))
                if both * 100 >= 85 * (len(x) + len(y) - both):
                    assert (i, j) in found
    assert counts[300] <= 6 * max(counts[100], 300)


def test_near_dedup_of_repeated_ids(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a), (3, a + " x"), (3, b), (3, b), (None, a), (4, None), (9, b + " y")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got) == [(0, 56, 0, True), (1, 56, 1, True), (3, 56, 3, True), (3, 56, 3, True), (3, 57, 1, False), (4, 0, 4, True), (9, 57, 3, False)]


def test_language_sample_is_that_of_the_lowest_hashes(spark):
    """Whether ids are distinct, so that a bound on the hash finds them, or one id has all rows of its language."""
    docs = spark.range(5000).selectExpr("id AS doc_id", "'w' || (10000 + id) AS text", "'aa' AS lang")
    mine = docs.where("pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 4) <> 2")
    want = [r.text for r in mine.orderBy(F.xxhash64("doc_id"), "doc_id").limit(10).collect()]
    repeated = spark.range(24_000).selectExpr("id % 40 AS doc_id", "'copy ' || (id % 40) AS text", "'l' || (id % 40) AS lang")
    samples = language_id.learn(docs.union(repeated), docs_per_language=10)
    assert samples["aa"].split() == want
    for k in range(40):
        known = zlib.crc32(str(k).encode()) % 4 != 2
        assert samples.get(f"l{k}") == (" ".join([f"copy {k}"] * 10) if known else None)


def test_many_languages_are_all_learned(spark):
    g = np.random.default_rng(1)
    rows = [(k, " ".join("".join(g.choice(list("abcdefgh"), 5)) for _ in range(30)), f"l{k % 151:03d}") for k in range(900)]
    samples = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), docs_per_language=1)
    assert len(samples) == 151
    short = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_chars=151 * 300)
    assert max(map(len, short.values())) <= 300


def test_mixing_draws_empty_documents_once(spark):
    rows = [(k, "w " * 50, "big") for k in range(40)] + [(100 + k, "w " * 50 if k else None, "small") for k in range(4)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), max_repeats=1.0, block_tokens=200, budget_tokens=8000.0).collect()
    times = Counter(r.doc_id for r in got)
    assert times[100] == 1
    drawn = Counter()
    for r in got:
        drawn[r.source] += r.n_tokens
    assert all(d <= 8000 * w + 1 and d > 8000 * w - 201 for s, d in drawn.items() for w in [next(r.weight for r in got if r.source == s)])
    for s in ("big", "small"):  # blocks of an epoch stand in one order, places in a block are gapless
        for e in {r.epoch for r in got if r.source == s}:
            by = defaultdict(list)
            for r in got:
                if (r.source, r.epoch) == (s, e):
                    by[(r.block_rank, r.block)].append(r.doc_rank)
            assert len({k[0] for k in by}) == len(by)


def test_chat_format(spark):
    rows = [(1, 0, "user", "a & <b> &lt; </turn>\n"), (1, 1, "assistant", "x\n\n"), (1, 1, "assistant", "x\n\n"), (1, 2, None, None), (2, 0, "assistant", ""), (None, 0, "system", "s")]
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.digests(chat_format.format_conversations(t.withColumn("parts", chat_format.text_parts(F.col("text"))))).collect()}
    read = "".join(f"{r or ''}\n{x or ''}\n" for c, _, r, x in rows if c == 1)
    assert got[1].n_turns == 4 and got[1].turns_sha256 == sha256(read.encode()).hexdigest()
    assert got[1].loss_chars == 6 and got[1].loss_sha256 == sha256(b"x\n\nx\n\n").hexdigest() and got[2].loss_chars == 0 and None in got


def test_chat_attachments(spark):
    parts = "array(named_struct('kind','text','text','see','ref',null,'size',null),named_struct('kind','image','text',null,'ref','i.png','size',2L),named_struct('kind','document','text',null,'ref','d.pdf','size',3L))"
    t = spark.range(2).selectExpr("1L conv_id", "id turn", "'user' role", f"{parts} parts")
    r = chat_format.format_conversations(t).first()
    assert "see<image 1/><document 2/>" in r.formatted and "<image 3/><document 4/>" in r.formatted
    assert [(a.number, a.ref) for a in r.attachments] == [(1, "i.png"), (2, "d.pdf"), (3, "i.png"), (4, "d.pdf")]
    assert r.expanded_tokens == 2 * (85 + 340 + 4 + 1800)


def test_fingerprints(spark, empty):
    t = texts()
    got = {r.doc_id: r for r in fingerprint_edits(spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")).collect()}
    for k in range(len(t)):
        a, b = t[k] or "", t[k - 1] or ""
        h = len(a) // 2
        assert got[k].n_chars == len(a) and got[k].edited_sha256 == sha256((a[: len(a) - h] + b[:h]).encode()).hexdigest()
        assert 0 <= got[k].near_edited <= 1 and 0 <= got[k].near_next <= 1
    assert got[4].fingerprint == got[5].fingerprint and got[5].near_next == 1.0 and got[9].near_next > 0.8
    assert fingerprint_edits(empty).count() == 0


def test_mixing(docs, empty):
    got = mixing.mix(docs, max_repeats=1.5, block_tokens=300).collect()
    tokens = Counter()
    for r in docs.collect():
        tokens[r.source] += len((r.text or "").split())
    drawn = Counter()
    for r in got:
        drawn[r.source] += r.n_tokens
    assert Counter(r.doc_id for r in got if r.epoch == 0) == Counter(r.doc_id for r in docs.collect())
    share = {s: n / sum(tokens.values()) for s, n in tokens.items()}
    a = mixing.temperature(max(share.values()), min(share.values()), 1.5)
    z = sum(p**a for p in share.values())
    for r in got:
        assert abs(r.weight - share[r.source] ** a / z) < 1e-4
    assert all(drawn[s] <= 1.5 * tokens[s] + 1 for s in tokens)
    seen = {(r.source, r.epoch, r.block, r.doc_rank) for r in got}
    assert len(seen) == len(got)
    high = mixing.mix(docs, max_repeats=None, entropy=0.99 * math.log(len(tokens)))
    assert high.count() >= 61 and mixing.mix(empty).count() == 0


def test_lm_scoring(docs, empty):
    got = lm_scoring.score_documents(docs, registry.byte_bpe(), steps=30, head=4).collect()
    w = {k: (t or "").encode().lower().split() for k, t in enumerate(texts())}
    ids = [*range(60), 10]
    train = [k for k in ids if zlib.crc32(str(k).encode()) % 7 != 2]
    c = Counter(x for k in train for x in w[k])
    n, v = sum(c.values()) + len(train), len(c) + 1
    assert len(got) == 61
    for r in got:
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w[r.doc_id]) + math.log10((len(train) + 1) / (n + v + 1))
        assert abs(base - r.base_score) < 1e-6 and r.n_known == sum(c[x] > 0 for x in w[r.doc_id]) + 1
        assert r.n_tokens == len(w[r.doc_id]) + 1 and r.train_tokens == n and r.score < 0 and r.held_out == (r.doc_id not in train)
    assert lm_scoring.score_documents(empty, registry.byte_bpe(), steps=2).count() == 0


def test_attention_scores_each_token_once():
    g = np.random.default_rng(2)
    seqs = [g.integers(0, 40, n) for n in (1, 7, 8, 9, 50)]
    m = AttentionModel(np.bincount(np.concatenate(seqs), minlength=60), end_id=59).fit(seqs, steps=40)
    x, y, counted, own = m.windows(seqs)
    assert counted.sum() == sum(map(len, seqs))
    h = m._hidden(x, {})[counted.ravel()]
    logp = m._choices(h, m.slot[y[counted]]) + m.other_log[y[counted]]
    want = np.bincount(np.broadcast_to(own[:, None], counted.shape)[counted], logp, len(seqs)) / np.log(10)
    assert np.allclose(want, m.score(seqs, at_once=3), atol=1e-3)


def test_attention_is_a_distribution():
    m = AttentionModel(np.arange(1, 5001), end_id=0).fit([np.arange(200) % 50], steps=5)
    total = sum(10 ** m.score([np.array([k])])[0] for k in range(0, 5000))
    assert abs(total - 1) < 1e-2


def test_attention_gradient():
    g = np.random.default_rng(4)
    m = AttentionModel(np.ones(30), end_id=0, width=8, hidden=8, stride=4).fit([g.integers(0, 30, 40)], steps=1)
    x, y, counted, _ = m.windows([g.integers(0, 30, 16)])
    slot = m.slot[y]
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    _, grad = m._step(x, slot, counted)
    for name in ("q", "k", "v", "o", "W1", "W2", "C", "P"):
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        e = 1e-5
        m.p[name][at] += e
        up = m._step(x, slot, counted)[0]
        m.p[name][at] -= 2 * e
        down = m._step(x, slot, counted)[0]
        m.p[name][at] += e
        assert abs((up - down) / (2 * e) - grad[name][at]) < 1e-3 * max(1, abs(grad[name][at]))


def test_attention_tells_rare_ids_apart():
    g = np.random.default_rng(6)
    rare = np.arange(4000, 4040)  # beyond the 3,071 most frequent
    counts = np.r_[np.full(4000, 50), np.full(40, 20), np.zeros(960, int)]
    follow = np.stack([rare, rare - 4000], 1)  # each is followed by an id of its own
    m = AttentionModel(counts, end_id=0).fit([follow[g.permutation(40)].ravel() for _ in range(60)], steps=200)
    assert len(set(m.slot[:4040].tolist())) == 4040 and len(set(m.slot[4040:].tolist())) == 1
    own, other = m.score([follow[k] for k in range(40)]), m.score([np.array([rare[k], (k + 7) % 40]) for k in range(40)])
    assert np.mean(own - other) > 1


def test_lm_scoring_learns_from_tails(spark):
    g = np.random.default_rng(8)
    ring = "water stone river light house paper green table music winter summer garden window mountain bridge forest".split()
    tail = " ".join(ring * 12)
    rows = [(k, " ".join(g.choice(WORDS, 620)) + " " + tail) for k in range(240)]  # the ring stands past word 600 only
    rows = [(k, t if zlib.crc32(str(k).encode()) % 7 != 2 else (tail if k % 2 else " ".join(g.permutation(ring * 12)))) for k, t in rows]
    got = lm_scoring.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), registry.byte_bpe(), steps=100).where("held_out").collect()
    known, mixed = [r.score for r in got if r.doc_id % 2], [r.score for r in got if not r.doc_id % 2]
    assert np.mean(known) > 0.5 * np.mean(mixed)  # log10 probabilities of the same words, in the order learned and in none


def test_lm_scoring_takes_every_id_once(spark):
    rows = [(k, " ".join(WORDS[(k + i) % len(WORDS)] for i in range(1 + 17 * k))) for k in range(60)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    ids = lm_scoring.WordIds.of(registry.byte_bpe())
    made = [ids.sequence(t, np.array([50_256], "<u4").tobytes()) for _, t in rows]
    counts = np.bincount(np.concatenate(made), minlength=50_257)
    first = AttentionModel(counts, 50_256).fit(made[:5], steps=3)
    got = [lm_scoring.further_trained(train.repartition(n), AttentionModel(counts, 50_256).fit(made[:5], steps=3), registry.byte_bpe(), 60, 13, most) for n, most in ((1, 2), (5, 50))]
    assert got[0].learned == got[1].learned == counts.sum()
    for k in first.p:
        assert np.allclose(got[0].p[k], got[1].p[k], atol=1e-6)  # whatever the partitions
    assert np.abs(got[0].p["U"] - first.p["U"]).max() > 0


def test_attention_training_without_spare_copies():
    g = np.random.default_rng(9)
    p = {"a": g.normal(size=(400, 300)).astype(np.float32), "b": g.normal(size=7).astype(np.float32)}
    want = {k: x.astype(float) for k, x in p.items()}
    m, v, adam = dict.fromkeys(p, 0.0), dict.fromkeys(p, 0.0), Adam(p)
    for t in (1, 2, 3):
        grad = {k: g.normal(size=x.shape).astype(np.float32) for k, x in p.items()}
        tracemalloc.start()
        adam.step(grad, 0.01)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < p["a"].nbytes / 2  # no array of a parameter's size is made
        for k, q in grad.items():
            m[k], v[k] = 0.9 * m[k] + 0.1 * q, 0.99 * v[k] + 0.01 * q.astype(float) ** 2
            want[k] -= 0.01 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
            assert np.allclose(p[k], want[k], atol=1e-5)


def test_attention_sums_by_slot():
    g = np.random.default_rng(10)
    for size in (50, 70_000):  # slots of two and of four bytes
        at, rows = g.integers(0, size, 400), g.normal(size=(400, 3))
        want = np.zeros((size, 3))
        np.add.at(want, at, rows)
        assert np.allclose(summed_rows(rows, at, size), want)
    m = AttentionModel(np.ones(300, int), end_id=0)
    seqs = [g.integers(0, 300, n) for n in (0, 1, 40, 0, 7, 0)]
    want = np.zeros((m.classes * m.places, 256))
    for s in seqs:
        np.add.at(want, (m.slot[s[1:]], m.slot[s[:-1]] % 256), 1.0)
    assert np.array_equal(m.contexts(seqs), want) and np.array_equal(m.contexts([], want.copy()), want)


def test_attention_steps_in_kept_arrays():
    g = np.random.default_rng(11)
    m = AttentionModel(np.ones(300, int), end_id=0).fit([g.integers(0, 300, 400)], steps=2)
    x, y, counted, _ = m.windows([g.integers(0, 300, n) for n in (1500, 43, 2000)])
    room, most = Room(np.float32), {}
    for a, b in ((0, 256), (256, 300), (100, 356)):  # a smaller step between two of one size
        at = slice(a, b)
        for kept in (None, room):
            tracemalloc.start()
            loss, grad = m._step(x[at], m.slot[y[at]], counted[at], kept)
            most[kept is room] = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            if kept is None:
                want = loss, {k: q.copy() for k, q in grad.items()}
        assert loss == want[0] and all(np.array_equal(grad[k], q) for k, q in want[1].items())
    assert most[True] < most[False] / 2


def test_lm_scoring_learns_from_ids_written_once(spark):
    rows = [(k, " ".join(WORDS[(k * i) % len(WORDS)] for i in range(1 + 9 * k))) for k in range(40)] + [(40, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("dealt", F.xxhash64("doc_id", "text")).select("doc_id", "dealt", "text")
    ids = lm_scoring.WordIds.of(registry.byte_bpe())
    made = [ids.sequence(t, np.array([50_256], "<u4").tobytes()) for _, t in rows]
    counts = np.bincount(np.concatenate(made), minlength=50_257)
    coded = lm_scoring.encoded(docs, registry.byte_bpe(), 50_257, 50_256)
    assert {r.doc_id: np.frombuffer(r.ids, "<u2").tolist() for r in coded.collect()} == dict(enumerate(x.tolist() for x in made))
    want = AttentionModel(counts, 50_256)
    assert np.array_equal(lm_scoring.contexts(coded, counts, 50_256), want.contexts(made))
    got = [lm_scoring.further_trained(d, AttentionModel(counts, 50_256).fit(made[:5], steps=3), registry.byte_bpe(), 41, 13, 9) for d in (docs.select("doc_id", "text"), coded)]
    assert got[0].learned == got[1].learned == counts.sum()
    assert all(np.allclose(got[0].p[k], got[1].p[k], atol=1e-6) for k in got[0].p)
    long = np.array([3, 70_000])  # beyond two bytes
    assert next(lm_scoring._parts([lm_scoring.coded(long, 70_001)], 70_001))[0].tolist() == long.tolist()


def test_attention_runs_learn_as_windows():
    g = np.random.default_rng(12)
    m = AttentionModel(np.ones(300, int), end_id=0).fit([g.integers(0, 300, 400)], steps=5)
    seqs = [g.integers(1, 300, n) for n in (1, 8, 9, 150, 1, 40)]
    x, y, counted, _ = m.windows(seqs)
    loss, want = m._step(x, m.slot[y], counted)
    room = Room(np.float32)
    for run in (1, 4, 16, 64):
        x, y, counted = m.runs(seqs, run)
        assert x.shape == (len(x), (run + 1) * m.stride)
        assert sorted(y[counted].tolist()) == sorted(np.concatenate(seqs).tolist())  # each id once
        for kept in (None, room):
            again, grad = m._run_step(x, m.slot[y], counted, kept)
            assert abs(again - loss) < 1e-5 and all(np.allclose(grad[k], q, atol=1e-5 * np.abs(q).max()) for k, q in want.items())
    # a part of many neighbours looks up a slot's keys and values once, not once for each window that sees it
    x, _, _ = m.runs([g.integers(1, 300, 8000)], 16)
    assert x.size < 1.1 * 8000
    p, learned = m.further([seqs, seqs[:1]], batch=8)
    assert learned == sum(map(len, seqs)) + 1 and np.abs(p["U"] - m.p["U"]).max() > 0


def test_lm_scoring_deals_shards_in_turn(spark):
    rows = spark.range(3000).select(F.pmod(F.xxhash64("id"), F.lit(30)).alias("shard"))
    for n, most in ((30, 1), (7, 5), (1, 30)):
        at = lm_scoring.in_turn(rows, "shard", n).select("shard", F.spark_partition_id().alias("p")).groupBy("p").agg(F.countDistinct("shard").alias("shards"), F.count("*").alias("rows")).collect()
        assert len(at) == n and max(r.shards for r in at) == most and sum(r.rows for r in at) == 3000
