"""Chat formatting, URL filters, and the pipeline against a plain version."""

import collections
import functools
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.llm import chat, quality, urls
from folioforge.llm.boosting import BINS, AdditiveModel, BoostedTrees, grow
from folioforge.llm.catalog import tokenizer_path
from test_texts import plain_groups, plain_leaks, plain_lines

# --- chat ------------------------------------------------------------------------------------------------------------

PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "~", "~0", "~1", "<", "[", "=", "a\nb", " ", "é", "[/INST", "</s", ""]


def test_round_trip(spark):
    rng = random.Random(1)
    text = lambda: "".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 6)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", "<s>", None]), rng.choice([text(), None])) for c in range(60) for t in range(rng.randrange(1, 5))]
    rows += [(None, 0, "user", "x"), (99, None, "assistant", "[INST]"), (99, None, "assistant", "[INST]"), (100, 0, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnRenamed("conv_id", "conv_id")
    formatted = chat.format_conversations(df)
    source = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        source.setdefault(c, []).append((r or "", x or ""))
    got = {r.conv_id: r for r in formatted.collect()}
    assert set(got) == set(source)
    for c, r in got.items():
        assert r.identical and [(t.role, t.text) for t in r.turns] == source[c]
        assert r.loss_text == "".join(x for role, x in source[c] if role == "assistant")
        assert r.formatted.count("[INST]") == r.formatted.count("</s>") == len(source[c])
    for d in chat.digests(formatted).collect():
        said = "".join(f"{r}\n{x}\n" for r, x in source[d.conv_id])
        assert (d.n_turns, d.turns_sha256) == (len(source[d.conv_id]), hashlib.sha256(said.encode()).hexdigest())
        assert (d.loss_chars, d.formatted_chars) == (len(got[d.conv_id].loss_text), len(got[d.conv_id].formatted))


def test_only_conflicts_are_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "a ~ b < c"), (2, 0, "user", "a <s> b"), (2, 1, "assistant", "~ plain")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.formatted for r in chat.format_conversations(df).collect()}
    assert got == {1: "<s>=user[INST]a ~ b < c[/INST]</s>", 2: "<s>~user[INST]a ~1s> b[/INST]</s><s>=assistant[INST]~ plain[/INST]</s>"}
    assert chat.format_conversations(df.limit(0)).collect() == []


# --- URLs ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "url,host,path,rule",
    [
        ("http://a.Example.COM/en/1?x=/#y", "a.example.com", "/en/1", "example.com/en/"), ("https://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/"),
        ("http://example.com/de/", "example.com", "/de/", "com/"), ("http://notexample.net/es/1", "notexample.net", "/es/1", "net/es/"), ("http://example.com", "example.com", "", None),
        ("http://xexample.com/en/1", "xexample.com", "/en/1", "com/"), ("http://a.org/", "a.org", "/", None), ("no scheme", "", "", None), (None, "", "", None), ("", "", "", None),
        ("x://h?q://z/", "h", "", None), ("http://a.b#f/x", "a.b", "", None), ("://com/x", "com", "/x", "com/"),
    ],
)
def test_rules(spark, url, host, path, rule):
    r = urls.filter_urls(spark.createDataFrame([(1, url, "x")], "page_id long, url string, host string")).first()
    assert (r.host, r.path, r.rule) == (host, path, rule)
    assert r.verdict == urls.RULES.get(rule, r.verdict) and r.verdict in ("allow", "block")


def plain_rule(url, rules):
    """(host, path, rule) by trying every rule on every ending of the host."""
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3 :]
        cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[: min((rest.index(c) for c in "?#" if c in rest), default=len(rest))]
    ends = {host[i:] for i in range(len(host) + 1) if i == 0 or host[i - 1] == "."}
    fits = [r for r in rules if r.split("/", 1)[0] in ends and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fits, key=len, default=None)


def test_rules_against_all_rules(spark):
    rng = random.Random(11)
    piece = ["http", "://", "www.", "example", ".com", ".net", "Example.COM", "com", "net", "/en/", "/es/", "/fr", "/", "?", "#", "x", ".", "É"]
    urls_ = ["".join(rng.choice(piece) for _ in range(rng.randrange(0, 9))) for _ in range(1500)] + [None, ""]
    urls_ += [f"http://{h}{p}" for h in ("com", "a.com", "acom", "net", "www.example.com", "w.www.example.com", "example.com.net") for p in ("", "/", "/en/", "/en", "/es/x", "/fr/?/")]
    got = urls.filter_urls(spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string")).collect()
    assert len(got) == len(urls_)
    for r in got:
        host, path, rule = plain_rule(urls_[r.page_id], urls.RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule), urls_[r.page_id]
        assert r.verdict == (urls.RULES[rule] if rule else r.verdict) and r.verdict in ("allow", "block")


def test_features_and_statistics_against_plain_ones(spark):
    rows = [("http://a.org/x-1?q=2&r=3#f", True), ("http://b.org/y", None), ("http://b.org/y", None), ("https://c.net/", False), ("https://c.net/", True), (None, True), ("", None)]
    folds = urls.suffix_statistics(spark.createDataFrame(rows, "url string, blocked boolean"))
    got = {r.suffix: (r.seen, r.bad) for r in folds.groupBy("suffix").agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad")).collect()}
    assert got == {"org": (2, 1), "net": (1, 1), "": (1, 0)}
    named = dict(zip(urls.FEATURES, urls.feature_matrix([rows[0][0], ""], np.array([2.0, 0]), np.array([1.0, 0]), 0.25)[0]))
    url = rows[0][0]
    entropy = -sum(url.count(c) / len(url) * math.log2(url.count(c) / len(url)) for c in set(url))
    expected = {"url_length": 26, "host_length": 5, "path_length": 4, "query_length": 8, "depth": 1, "labels": 2, "digit_ratio": 3 / 26, "hyphens": 1, "entropy": entropy, "parameters": 3,
                "has_fragment": 1, "https": 0, "dots_in_path": 0, "longest_part": 3, "host_digit_ratio": 0, "vowel_ratio": 2 / 5, "suffix_block": (1 + 4 * 0.25) / 6, "suffix_seen": math.log(3)}
    assert named == pytest.approx(expected)


def test_hosts_that_were_never_fitted(spark):
    """Labels by a pattern of the URL: trees fitted without every fifth host judge that host's URLs."""
    rng = random.Random(2)
    rows = []
    for i in range(2000):
        bad = i % 2 == 0
        host = f"{'x' if rng.random() < 0.5 else 'site'}{rng.randrange(60)}.{rng.choice(['com', 'net', 'org'])}"
        path = "/".join("%06d" % rng.randrange(10**6) if bad and rng.random() < 0.7 else rng.choice(["news", "about", "team", "blog"]) for _ in range(rng.randrange(2, 5)))
        rows.append((f"http://{host}/{path}" + ("?id=%d&s=%d" % (i, i) if bad and rng.random() < 0.6 else ""), bad, int(re.findall(r"\d+", host)[0])))
    df = spark.createDataFrame(rows, "url string, blocked boolean, number int")
    fitted = df.filter("number % 5 <> 0").select("url", "blocked")
    got = urls.filter_urls(df.filter("number % 5 = 0").withColumn("page_id", F.monotonically_increasing_id()), rules={}, labelled=fitted).collect()
    truth = {u: b for u, b, _ in rows}
    pages = {r.page_id: r for r in got}
    held = df.filter("number % 5 = 0").withColumn("page_id", F.monotonically_increasing_id()).collect()
    blocked = [truth[r.url] for r in held if pages[r.page_id].verdict == "block"]
    assert np.mean(blocked) > 0.9 and sum(blocked) > 0.93 * sum(truth[r.url] for r in held)


def test_trees_that_know_nothing_block_nothing():
    rng = np.random.default_rng(0)
    x, fold = rng.random((600, 3)), rng.integers(0, 5, 600)
    assert urls.block_threshold(x, (rng.random(600) < 0.6).astype(float), fold) > 0.8
    assert urls.block_threshold(x[:0], np.zeros(0), fold[:0]) == np.inf and urls.block_threshold(x, np.zeros(600), fold) == np.inf
    known = urls.block_threshold(x, (x[:, 0] > 0.5).astype(float), fold)
    assert 0.5 <= known < 0.95 and urls.block_threshold(x, np.ones(600), fold) <= 1


def plain_boosting(x, y, rounds, depth, rate, ridge, columns):
    """Scores by trying every cut of every node on its rows, with gradients as whole numbers."""
    draw, units = np.random.default_rng(0), 2**24
    cuts = [sorted(set(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1]).tolist())) for j in range(x.shape[1])]
    z = [math.log((y.sum() + 1) / (len(y) - y.sum() + 1))] * len(y)
    gain = lambda g, h: (g / units) ** 2 / (h / units + ridge)
    for _ in range(rounds):
        seen = draw.permutation(x.shape[1])[: max(1, round(columns * x.shape[1]))].tolist()
        p = [1 / (1 + math.exp(-v)) for v in z]
        g, h = [round((t - q) * units) for t, q in zip(y, p)], [round(q * (1 - q) * units) for q in p]
        total = lambda rows: (sum(g[r] for r in rows), sum(h[r] for r in rows))
        nodes = [list(range(len(y)))]
        for _ in range(depth):
            below = []
            for rows in nodes:
                best, sides = 1e-9, (rows, [])
                for j in seen:
                    for c in cuts[j]:
                        left, right = [r for r in rows if x[r, j] < c], [r for r in rows if x[r, j] >= c]
                        more = gain(*total(left)) + gain(*total(right)) - gain(*total(rows))
                        if more > best + 1e-12:
                            best, sides = more, (left, right)
                below += sides
            nodes = below
        for rows in nodes:
            sum_g, sum_h = total(rows)
            for r in rows:
                z[r] += rate * (sum_g / units) / (sum_h / units + ridge)
    return [1 / (1 + math.exp(-v)) for v in z]


@pytest.mark.parametrize("seed", range(4))
def test_boosted_trees_against_plain_ones(seed):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, 90), rng.integers(0, 3, 90), rng.integers(0, 40, 90), np.full(90, 7)]).astype(float)
    y = ((x[:, 0] + 4 * x[:, 1] + rng.integers(0, 9, 90)) > 14).astype(float)
    for how in ({"rounds": 12, "depth": 3, "rate": 0.2, "ridge": 1.0, "columns": 0.5}, {"rounds": 5, "depth": 2, "rate": 0.5, "ridge": 0.1, "columns": 1.0}):
        assert BoostedTrees.fit(x, y, **how).predict(x) == pytest.approx(plain_boosting(x, y, **how), abs=1e-9)
    for ones in (np.zeros(90), np.ones(90)):
        assert BoostedTrees.fit(x, ones, rounds=3).predict(x) == pytest.approx(plain_boosting(x, ones, 3, 3, 0.2, 1.0, 0.5), abs=1e-9)


def test_threshold_against_every_score():
    rng = np.random.default_rng(3)
    for most in (0.3, 0.6, 0.95):
        counts = np.zeros((101, 2), int)
        for s, bad in zip(rng.integers(0, 101, 80), rng.random(80) < most):
            counts[s] += 1, bad
        good = [s for s in range(101) if counts[s, 0] and counts[s:, 1].sum() >= urls.PRECISION * counts[s:, 0].sum()]
        assert urls.lowest_score(counts) == (max(0.5, min(good) / 100) if good else np.inf)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="the driver's tables are not here")
def test_trees_decide_where_no_rule_fits(spark):
    """On the driver's pages the score, not a constant, decides; unlabelled URLs of a suffix don't dilute its share of blocked ones."""
    got = urls.filter_urls(spark.read.parquet("/root/testdata/sf0.1/pages.parquet")).filter("rule IS NULL").collect()
    scores = {v: [r.block_score for r in got if r.verdict == v] for v in ("allow", "block")}
    assert scores["allow"] and scores["block"] and max(scores["allow"]) < min(scores["block"])
    diluted = urls.feature_matrix(["http://a.net/"], np.array([800.0]), np.array([200.0]), 0.5, np.array([200.0]))[0]
    assert diluted[urls.FEATURES.index("suffix_block")] == pytest.approx(202 / 204)


def test_all_labelled_urls_are_fitted(spark, monkeypatch):
    """More labelled URLs than were fitted once, in arrays and in passes over the executors: the same trees, from all of them."""
    rng = random.Random(4)
    rows = [(f"http://h{rng.randrange(900)}.{rng.choice(['com', 'net', 'org'])}/{'x' * rng.randrange(9)}/{i}", rng.random() < 0.3) for i in range(20_700)]
    rows = [(u + "?id=1", True) if i % 50 == 0 else (u, bad and "xxxxx" in u) for i, (u, bad) in enumerate(rows)]
    df = spark.createDataFrame([*rows, *rows[:40], (None, True), ("http://a.org/", None)], "url string, blocked boolean")
    statistics = urls.suffix_statistics(df)
    monkeypatch.setattr(urls, "grow", functools.partial(grow, rounds=12), raising=False)
    fitted = []
    for held in (10**6, 0):
        monkeypatch.setattr(urls, "HELD", held, raising=False)
        fitted.append(urls.fit_urls(df, statistics))
        bad = sum(b for _, b in rows)
        assert fitted[-1][1].bias == pytest.approx(math.log((bad + 1) / (len(rows) - bad + 1)), abs=1e-12)
    (rate, trees, threshold), (rate_2, trees_2, threshold_2) = fitted
    assert (rate, threshold) == (rate_2, threshold_2) and 0.5 <= threshold < 1
    for one, two in zip(trees.trees, trees_2.trees, strict=True):
        assert all((a == b).all() for a, b in zip(one, two))


def test_model_learns_from_labels(spark):
    suffix = ["com", "net", "org"]
    rows = [(i, f"http://{'shop' if i % 2 else 'news'}{i % 7}.{suffix[i % 3]}/{'es' if i % 2 else 'de'}/{i}", None) for i in range(300)]
    rows += [(900, "http://shop3.org/es/5", None), (901, "http://news3.org/de/5", None), (902, None, None), (900, "http://shop3.org/es/5", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    labelled = spark.createDataFrame([(u, i % 2 == 1) for i, u, _ in rows[:300]] + [(None, True), ("http://x.org/", None)], "url string, blocked boolean")
    got = urls.filter_urls(df, rules={}, labelled=labelled).collect()
    assert len(got) == len(rows)
    assert {r.page_id: r.verdict for r in got if r.page_id in (900, 901)} == {900: "block", 901: "allow"}
    alone = urls.filter_urls(df, rules={}).collect()
    assert {r.verdict for r in alone} == {"allow"} and urls.filter_urls(df.limit(0)).collect() == []


# --- pipeline --------------------------------------------------------------------------------------------------------


def test_pipeline_on_small_tables(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(900)]
    doc = lambda n=120: [rng.choice(vocabulary) for _ in range(n)]
    leak = doc(30)
    rows, quality = [], []
    for i in range(120):
        rows.append((i, "\n".join(" ".join(doc(40)) for _ in range(3)), "en", "s"))
        quality.append((i, 1, 0))
    for i in range(120, 180):
        rows.append((i, " ".join(rng.choice(["BUY!!", "$$$", "NOW***"]) for _ in range(90)) + " " + str(i), "en", "s"))
        quality.append((i, 0, 0))
    rows.append((200, rows[5][1], "en", "s"))  # an exact copy: it loses its lines and then counts as empty
    near = rows[6][1].replace("\n", " ").split()
    rows.append((201, " ".join([*near[:50], "changed", *near[51:]]), "en", "s"))
    rows.append((202, " ".join([*doc(50), *leak, *doc(50)]), "en", "s"))
    rows.append((203, "\n".join([" ".join(doc(30)), rows[7][1].split("\n")[0]]), "en", "s"))
    table = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(quality, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, " ".join(leak))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == table.columns, name
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert set(range(120)) - set(kept) == set()  # clean documents stay
    assert not set(range(120, 180)) & set(kept) and 201 not in kept and 202 not in kept
    assert kept[203] == rows[-1][1].split("\n")[0] and kept.get(200, "") == ""
    out = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert out == set(kept)


def plain_features(text):
    """quality.FEATURES character by character."""
    raw, n = text.encode(), max(1, len(text))
    share = lambda test: sum(map(test, text)) / n
    space, mark = set(" \t\n\x0b\x0c\r"), set("#$%&*+<=>@\\^_`{|}~")
    plain = lambda c: c < "\x80" and c.isalnum()
    words = re.findall("[^ \t\n\x0b\x0c\r]+", text)
    some = list(dict.fromkeys(words))
    lines, w = text.split("\n"), max(1, len(words))
    bytes_ = collections.Counter(raw)
    capital = lambda x: re.search("[A-Z]", x) and not re.search("[a-z]", x)
    return [
        math.log(1 + len(raw)), share(lambda c: "A" <= c <= "Z"), share(lambda c: "0" <= c <= "9"), share(lambda c: c < "\x80" and c not in space and not plain(c)),
        share(lambda c: c == "."), share(lambda c: c in ",;:"), share(lambda c: c in "!?"), share(lambda c: c in mark), sum(b > 127 for b in raw) / n, share(lambda c: c in space),
        sum(len(x.encode()) for x in words) / w, max((len(x.encode()) for x in some), default=0) / 32, len(some) / w,
        math.log(1 + len(words)), min(200, w / len(lines)), len(set(lines)) / len(lines), min(100, w / (1 + sum(c in ".!?" for c in text))),
        max((words.count(x) for x in some), default=0) / w, -sum(k / len(raw) * math.log2(k / len(raw)) for k in bytes_.values()),
        sum(x[-1] < "\x80" and not plain(x[-1]) and x[-1] not in ".,;:" for x in some) / max(1, len(some)), sum(bool(capital(x)) for x in some) / max(1, len(some)),
    ]


def plain_score(model, x):
    place = lambda v, cuts: sum(c <= v for c in cuts)
    z = model.bias + sum(t[place(v, c)] for v, c, t in zip(x, model.cuts, model.tables))
    for (i, j), t in zip(model.pairs, model.pair_tables):
        z += t[place(x[i], model.pair_cuts[i]), place(x[j], model.pair_cuts[j])]
    return 1 / (1 + math.exp(-z))


def test_pipeline_against_a_plain_version(spark, tmp_path):
    """All documents of the smallest tables, with copies, leaks and odd texts, through stages written out plainly."""
    from tokenizers import Tokenizer

    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    read = lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
    rows = [tuple(r) for r in read("documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    rng = random.Random(12)
    long = [r for r in rows if 60 < len(r[1].split()) < 2000]
    for k, r in enumerate(rng.sample(long, 30)):
        words = r[1].split(" ")
        at = rng.randrange(len(words))
        text = (" ".join([*words[:at], "zq", *words[at + 1 :]]), " ".join([*words[:at], items[k][1], *words[at:]]), r[1])[k % 3]
        rows.append((10_000 + k, text, *r[2:]))
    rows += [(20_000, None, "en", "s", 0), (20_001, "", "en", "s", 0), (20_002, "\n\n", "en", "s", 2), (20_003, "one", "en", "s", 3)]
    spark.createDataFrame(rows, read("documents").select("doc_id", "text", "lang", "source", "n_chars").schema).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("benchmark", "labels"):
        read(name).write.parquet(f"{tmp_path}/{name}.parquet")

    texts = {i: t or "" for i, t, *_ in rows}
    for t in texts.values():
        assert quality.features(t.encode()) == pytest.approx(plain_features(t), rel=1e-9, abs=1e-12)
    x = {i: quality.features(t.encode()) for i, t in texts.items()}
    labels = sorted((r.doc_id, r.quality) for r in read("labels").collect() if r.doc_id in texts and r.quality in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 3 != 1)
    model = AdditiveModel.fit(np.array([x[i] for i, _ in labels]), np.array([q for _, q in labels], float))
    kept = {i: t for i, t in texts.items() if plain_score(model, x[i]) >= 0.5}
    assert len(kept) < len(texts)
    kept = {i: t for i, _, _, t in plain_lines(sorted(kept.items()))}
    first = plain_groups({i: t.encode() for i, t in kept.items()})
    assert len(first) < len(kept)
    shingles = lambda t: {tuple(w[j : j + 5]) for w in [re.findall(rb"[0-9a-z\x80-\xff]+", t.encode().lower())] for j in range(max(1, len(w) - 4))}
    theirs = [(i, t, shingles(t)) for i, t in items]
    clean = {}
    for i in first:  # a window and an item of similarity 0.8 share a shingle; short ones are compared anyway
        own = shingles(kept[i])
        some = [(n, t) for n, t, s in theirs if s & own or min(map(len, s | own)) < 5]
        if not plain_leaks([(i, kept[i])], some):
            clean[i] = kept[i]
    assert 0 < len(clean) < len(first)
    library = Tokenizer.from_file(tokenizer_path())
    expected = {}
    for i, t in clean.items():
        ids = library.encode(t, add_special_tokens=False).ids
        expected[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256) for r in got} == expected and len(got) == len(expected)
