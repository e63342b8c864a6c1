"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns; against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, hashes string, node int, size string, rank int"
LINE = "the quick brown fox number {} jumps over the lazy dog and {} runs away from it all"


def rows(seed=3, n=24):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        text = " ".join(r.choice(words) for _ in range(r.randrange(1, 120)))
        out.append([i, text, "ab"[i % 2], f"s{i % 3}"])
    base = " ".join(r.choice(words) for _ in range(150))
    out += [[100, base, "a", None], [101, base, "b", "s1"], [102, base.replace(base.split()[40], "changed", 1), "a", "s1"], [102, base, "a", "s1"]]
    shared = " ".join(r.choice(words) for _ in range(60))
    out += [[110, "one " + shared + " two", "a", "s2"], [111, "é three " + shared + " four ü", "b", "s2"]]
    out += [[200, None, None, None], [201, "", "a", "s0"], [202, " \n\t", "b", None], [None, "a text without id", "a", "s0"], [203, "Ünïcode ẞ 漢字 ½", None, "é"], [204, "x" * 5000, "a", "s0"], [205, "AB " * 3000, "b", "s1"]]
    return [(a, t, l, s, len(t or ""), "h", 1, "z", 9) for a, t, l, s in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_packing(docs, none):
    from tokenizers import Tokenizer

    from busframe.llm.packing import cuts, pack

    t = Tokenizer.from_file(tokenizer())
    out = pack(docs, tokenizer()).toPandas()
    want = Counter()
    for a, text, *_ in rows():
        want[a] += len(t.encode(text or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for r in out.itertuples():
        got[None if r.doc_id != r.doc_id else int(r.doc_id)] += r.length
        assert len(r.ids) == 4 * r.length
    assert got == want
    one = out[out.doc_id == 203].sort_values("start")
    ids = np.frombuffer(b"".join(one.ids), "<u4").tolist()
    assert ids == [*t.encode("Ünïcode ẞ 漢字 ½", add_special_tokens=False).ids, 1]
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 2048
    assert pack(none, tokenizer()).count() == 0
    for n in range(1, 5000, 7):
        assert sum(x for x, _ in cuts(n, 2048)) == n and all(2048 / (k + 1) < x <= 2048 / k for x, k in cuts(n, 2048))


def test_packing_clashing_columns(spark):
    from busframe.llm.packing import pack

    d = spark.createDataFrame([(1, "a b", "x", 5, b"y"), (1, "a b", None, 5, b"y"), (None, None, "z", None, None)], "doc_id long, text string, start string, length int, ids binary")
    out = pack(d, tokenizer()).collect()
    assert Counter((r.doc_id, r.doc_tokens) for r in out if r.start == 0) == {(1, 3): 2, (None, 1): 1} and sum(r.length for r in out) == 7


def test_word_ids_match_tokenizer():
    from busframe.llm.packing import WordIds

    w = WordIds(tokenizer())
    texts = ["It's o'clock; ßü Straße ÀÉ x2y3z4", "á èb c  d", "Σίσυφος ΣΑΣ 12½ ４", "\x1c a\x0bb\x0cc", "don''t 'll '' ...!!", "a​b \U0001f600ok", ""]
    for a, e in zip(w.encode(texts), w.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(a, "<u4").tolist() == e.ids


def test_fingerprint(spark, docs, none):
    from busframe.llm.fingerprint import add, fingerprints, subtract, text_form, with_lanes

    out = fingerprints(docs).collect()
    assert len(out) == len(rows())
    texts = {r[0]: r[1] or "" for r in rows() if r[0] not in (102, None)}
    by_text = {}
    for r in out:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id in texts:
            assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
            assert r.n_chars == len(texts[r.doc_id])
    assert {r.doc_id: r.edited_text for r in out}[205] == texts[205][:6000] + texts[204][:3000]
    assert by_text[texts[0]] != by_text[texts[1]]
    assert fingerprints(none).count() == 0
    d = spark.createDataFrame([("one, two\nthree", "four five.", "one, two\nthree\nfour five.", "four five.\nthree\none, two")], "a string, b string, both string, mixed string")
    for c in ("a", "b", "both", "mixed"):
        d = with_lanes(d, c, f"_{c}")
    r = d.select(text_form(add(F.col("_a"), F.col("_b"))).alias("sum"), text_form(F.col("_both")).alias("both"), text_form(F.col("_mixed")).alias("mixed"), text_form(subtract(F.col("_both"), F.col("_b"))).alias("less"), text_form(F.col("_a")).alias("a")).first()
    assert r["sum"] == r.both == r.mixed and r.less == r.a


def test_fingerprint_repeats(spark):
    from busframe.llm.fingerprint import PARTS, likeness, with_lanes

    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(2, 9)))
    clauses = [" ".join(word() for _ in range(6)) + "." for _ in range(30)]
    line, other = (" ".join(word() for _ in range(500)) for _ in range(2))
    solid = "".join(r.choice("天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往秋收冬藏") for _ in range(900))
    blob, blob2 = ("".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(3000)) for _ in range(2))
    pairs = [(" ".join(clauses[:20] * k), " ".join((clauses[:14] + clauses[24:]) * k)) for k in (1, 5, 20, 100)]
    pairs += [(x, x[: len(x) * 2 // 3] + y[: len(x) // 3]) for x, y in ((line, other), (solid, solid[::-1]), (blob, blob2), (blob, "!" + blob), (clauses[0] * 200, clauses[1] * 200))]
    pairs += [(line, other), (" ".join(clauses[:3] * 9000), " ".join(clauses[3:6] * 9000)), ("x" * 5000, "x" * 4000)]
    d = spark.createDataFrame(pairs, "a string, b string").withColumns({c + "p": F.filter(F.split(c, PARTS), lambda x: x != "") for c in "ab"})
    d = with_lanes(with_lanes(d, "a", "_a"), "b", "_b").withColumn("like", likeness(F.col("_a"), F.col("_b")))
    wants = []
    for x in d.select("ap", "bp", "like").collect():
        a, b = Counter(x.ap), Counter(x.bp)
        wants.append((a & b).total() / (a | b).total())
        assert abs(x.like - wants[-1]) < 0.2, (wants, x.like)
    assert min(wants[:8]) > 0.3 and max(wants[9:11]) < 0.1


def test_fingerprint_long_text(spark):
    """200,000 parts under ANSI arithmetic; half of them shared."""
    from busframe.llm.fingerprint import PARTS, fingerprints

    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    clauses = [f"clause {i}." for i in range(300_000)]
    texts = {2: " ".join(clauses[:200_000]), 1: " ".join(clauses[100_000:]), 0: "x"}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {r.doc_id: r for r in fingerprints(d).collect()}
    parts = d.select("doc_id", F.explode(F.filter(F.split("text", PARTS), lambda x: x != "")).alias("p")).groupBy("doc_id").agg(F.collect_list("p").alias("p")).collect()
    parts = {r.doc_id: Counter(r.p) for r in parts}
    want = {i: (parts[i] & parts[i - 1]).total() / (parts[i] | parts[i - 1]).total() for i in (1, 2)}
    assert parts[2].total() >= 200_000 and abs(out[2].near_next - want[2]) < 0.15 and abs(out[1].near_next - want[1]) < 0.05 and 0.3 < out[2].near_edited < 0.9


def test_fingerprint_edits(spark):
    """Edited texts of all documents against a plain loop, over several ranges of ids."""
    from busframe.llm.fingerprint import fingerprints

    r = random.Random(8)
    texts = {i: "".join(r.choice("ab é\n漢\U0001F600") for _ in range(r.choice([0, 1, 2, 3, 40, 200]))) for i in r.sample(range(-500, 500), 120)}
    out = {x.doc_id: x for x in fingerprints(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)).collect()}
    ids = sorted(texts, reverse=True)
    for i, nxt in zip(ids, ids[1:] + ids[:1]):
        n = len(texts[i])
        assert out[i].n_chars == n and out[i].edited_text == texts[i][: n - n // 3] + texts[nxt][: n // 3]
        assert out[i].near_edited == 1 or out[i].fingerprint != out[i].edited_fingerprint


def test_fingerprint_likeness(spark):
    """Short and long texts' likeness against counts of the parts that they share."""
    from busframe.llm.fingerprint import PARTS, likeness, with_lanes

    r = random.Random(6)
    say = lambda n: [r.choice("alpha bravo carbon delta, echo fox. golf hotel india july kilo lima mike".split()) + str(r.randrange(60)) for _ in range(n)]
    pairs = []
    for n in (3, 6, 10, 20, 20, 40, 40, 90, 400, 3000):
        for part in (0.1, 0.3, 0.7, 1.0):
            a, b = say(n), say(n)
            pairs.append((n, " ".join(a), " ".join(b[: int(part * n)] + a[int(part * n) :])))
    d = with_lanes(with_lanes(spark.createDataFrame(pairs, "n int, a string, b string"), "a", "_a"), "b", "_b")
    cut = lambda c: F.filter(F.split(c, PARTS), lambda x: x != "")
    off = {}
    for x in d.select("n", cut("a").alias("a"), cut("b").alias("b"), likeness(F.col("_a"), F.col("_b")).alias("near"), likeness(F.col("_b"), F.col("_a")).alias("back")).collect():
        a, b = Counter(x.a), Counter(x.b)
        true = sum((a & b).values()) / sum((a | b).values())
        off.setdefault(x.n, []).append(abs(x.near - true))
        assert x.near == x.back
    short = [x for n, v in off.items() if n <= 20 for x in v]
    assert sum(short) / len(short) < 0.03 and max(max(v) for v in off.values()) < 0.25, off  # two parts that meet in a count hide each other


def test_fingerprint_heavy_parts(spark):
    """One part of each text outweighs its many others; each part costs one tangent a lane of its group, eight at most."""
    from busframe.llm.fingerprint import PARTS, WIDE, likeness, with_lanes

    assert WIDE <= 8
    r = random.Random(4)
    word = lambda: "".join(r.choice("bcdfghjklm") for _ in range(7)) + "."
    pairs = []
    for _ in range(30):
        heavy, own, both = (word(), word()), ([word() for _ in range(40)], [word() for _ in range(40)]), [word() for _ in range(r.choice([100, 400]))]
        pairs.append(tuple(" ".join([heavy[i]] * 150 + own[i] + both) for i in range(2)))
    d = spark.createDataFrame(pairs, "a string, b string").withColumns({c + "p": F.filter(F.split(c, PARTS), lambda x: x != "") for c in "ab"})
    d = with_lanes(with_lanes(d, "a", "_a"), "b", "_b").withColumn("like", likeness(F.col("_a"), F.col("_b")))
    off = []
    for x in d.select("ap", "bp", "like").collect():
        a, b = Counter(x.ap), Counter(x.bp)
        off.append(abs(x.like - (a & b).total() / (a | b).total()))
    assert max(off) < 0.15, off


def test_fingerprint_hot_ids(spark):
    """A third of the rows without an id and a third with one id: every row has its next one, by the texts' hashes."""
    import xxhash
    from busframe.llm.fingerprint import fingerprints

    texts = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} " * 3) for i in range(600)]
    out = fingerprints(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    signed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + (1 << 63)) % (1 << 64)
    ordered = sorted(texts, key=lambda x: (x[0] is None, -(x[0] or 0), signed(x[1])))
    want = Counter((a[0], a[1][: len(a[1]) - len(a[1]) // 3] + b[1][: len(a[1]) // 3]) for a, b in zip(ordered, ordered[1:] + ordered[:1]))
    assert Counter((r.doc_id, r.edited_text) for r in out) == want


PAGE = """<!DOCTYPE html><html><head><title>Site</title><script>var x="</p><p>no";</script></head><body class="has-sidebar"><header>Site name</header><nav><ul><li><a href=/>Home</a><li><a href=/b>More</a></ul></nav>
<div class="cookie-notice">We use cookies on this site, please accept all of them now.</div><div id="content"><h1>Title &amp; more</h1><div class="post-body"><p>First <b>para</b>graph with &eacute; and&nbsp;space,
which is rather long so that it counts as text.<p>Second paragraph, also long enough to be taken as part of the main text, with a <a href="/x">link</a>.<br>After a break.</div></div><aside>Other things</aside>
<div class="comments"><p>I did not like this article at all, said a reader at length and with many words.</p></div><form>Your mail <input></form><div class="advert">Buy!</div><footer>&copy; nobody</footer></body></html>"""


def test_html():
    from busframe.llm.html_text import main_text

    want = "Title & more First paragraph with é and space, which is rather long so that it counts as text. Second paragraph, also long enough to be taken as part of the main text, with a link. After a break."
    assert main_text(PAGE) == want
    assert main_text("<p>unclosed <b>a &lt; b") == "unclosed a < b"
    assert main_text("plain text") == "plain text"
    assert main_text("<nav>menu</nav><!-- x -->") == "" and main_text("<") == "<"
    assert main_text("<article><h1>Hi</h1><p>Short.</p></article><p>outside") == "Hi Short."
    said = "Words of the article that are many enough to be told from what lies around them on the page."
    for name in ("content-ad", "banner-ad", "video-ad", "in-article-ad", "ad-300x250", "fb-comments", "cookie-policy-popup", "cookiePolicyBox"):
        assert main_text(f'<article><p>{said}</p><div class="{name}">Buy this thing now, it is cheap and good for everyone.</div><p>{said}</p></article>') == f"{said} {said}", name
    for name in ("has-sidebar", "with-sidebar", "no-ads", "advice", "header-free", "promotion-theory", "commentary", "shadow"):
        assert main_text(f'<body><div class="{name}"><p>{said}</p><p>{said}</p></div></body>') == f"{said} {said}", name
    assert main_text(f'<body><form id="aspnet"><header>Site</header><div><h1>Title</h1><p>{said}</p></div><footer>end</footer></form></body>') == f"Title {said}"
    plain = "This paragraph is long and mostly plain words, with a link at its end that has "
    assert main_text(f"<body><div><p>{plain}<a href=x>{'&eacute;' * 12}</a></p><p>{said}</p></div></body>") == f"{plain}{'é' * 12} {said}"
    assert len(main_text("<p>" + "word " * 400_000 + "</p>")) == 5 * 400_000 - 1


@pytest.mark.parametrize("page", ["<div>x", "<form>x", '<a b="', '<a x=">"', "<svg>x", "<p>x", "<ul><li>x", '<div class="cookies-recipe">x', "<a '\">", "<!--", "<a", '<div class="in-article-ad">x'])
def test_html_deep(page):
    """Time grows with the page, whatever is left open in it."""
    import time

    from busframe.llm.html_text import main_text

    began = time.process_time()
    main_text(page * 200_000)
    for closing in ("</section>", "</p>", "</a>", "-->"):
        main_text(page * 20_000 + closing * 20_000)
    assert time.process_time() - began < 20


def test_html_boxes():
    """A name decides where it says nothing else; where it does, what the box holds."""
    from busframe.llm.html_text import main_text

    say = lambda x: f"The {x} of this matter is told here at some length, in plain words, so that it reads as any paragraph does."
    page = lambda box: f"<body><nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{say('first')}</p>{box}<p>{say('last')}</p></article><footer>(c)</footer></body>"
    plain = f"Title {say('first')} {say('last')}"
    for name in ("outbrain", "taboola-feed", "dianomi", "paywall-prompt", "author-bio", "tag-cloud", "talkback", "guestbook", "privacy-bar", "you-may-like", "more-stories", "popular-posts", "trending", "mpu", "leaderboard", "share-this", "in-article-ad", "cookiePolicyBox", "comments", "notice"):
        assert main_text(page(f'<div class="{name}"><p>{say("box")}</p></div>')) == plain, name
    for name in ("consent-theory", "cookies-recipe", "sidebar-note", "promo-theory"):
        assert main_text(page(f'<div class="{name}"><p>{say("box")}</p></div>')) == f"Title {say('first')} {say('box')} {say('last')}", name
        assert main_text(page(f'<div class="{name}"><p>Buy it now</p></div>')) == plain, name
        assert main_text(page(f'<div class="{name}"><p><a href=x>{say("box")}</a></p></div>')) == plain, name


def test_html_table(spark):
    from busframe.llm.html_text import extract

    p = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (3, "v", "", "y")], "page_id long, url string, html string, text string")
    out = extract(p, keep=["page_id", "url", "text"]).collect()
    assert sorted(r.n_chars for r in out) == [0, 0, len(out[0].text), len(out[0].text)] and out[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    assert extract(p.limit(0), keep=["page_id"]).count() == 0


@pytest.mark.parametrize("queries", [16_384, 3])
def test_topk(spark, monkeypatch, queries):
    from busframe.llm import topk

    monkeypatch.setattr(topk, "QUERIES", queries)
    monkeypatch.setattr(topk, "BLOCK", 40)
    r = np.random.default_rng(1)
    v = [(i, r.normal(size=8).astype("f4").tolist(), 0) for i in range(300)] + [(300, None, 1), (301, [], 1), (450, [], 1), (302, [1.0, None] + [0.0] * 6, 1), (303, [float("nan")] * 8, 1), (304, [float("inf")] * 8, 1), (305, [0.5, 0.25], 1), (350, [1.0, 2.0], 1), (None, [1.0] * 8, 1)]
    v += [(i + 1000, v[7][1], 2) for i in range(8)] + [(50, [1.0, 1.0], 1), (50, [3.0, 3.0], 1), (50, [3.0, 3.0], 1), (100, v[100][1], 1)]  # repeated ids and rows
    out = topk.search(spark.createDataFrame(v, "vec_id long, embedding array<float>, rank int").repartition(3), F.col("vec_id") % 50 == 0, 5)
    got = Counter(map(tuple, out.select("query_id", "rank", "vec_id", "score").collect()))
    whole = [(i, np.floor(256 * np.array(x, "f4").astype("f8")).astype("i8")) for i, x, _ in v if i is not None and x is not None and None not in x and np.isfinite(x).all()]
    want = Counter()
    for a, (q, x) in enumerate(whole):
        if q % 50 == 0:
            best = sorted((-int(x @ y), i) for b, (i, y) in enumerate(whole) if a != b and len(x) == len(y))[:5]
            want.update((q, k + 1, i, -s) for k, (s, i) in enumerate(best))
    assert got == want
    assert topk.search(out.select(F.col("vec_id"), F.array("score").cast("array<float>").alias("embedding")).limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_mixing(docs, none):
    from busframe.llm.mixing import fit, mix

    out = mix(docs, keep=["doc_id", "text", "size"]).toPandas()
    again = mix(docs, keep=["doc_id", "text", "size"]).toPandas()
    assert sorted(zip(out.text.fillna(""), out.copies)) == sorted(zip(again.text.fillna(""), again.copies))
    assert len(out) == len(rows()) and out.columns.tolist() == ["doc_id", "text", "size", "source_size", "target", "copies"]
    sizes = {}
    for _, text, _, source, *_ in rows():
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(s for s in sizes if s is not None) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, budget, left = {}, 1.5 * sum(sizes.values()), set(order)
    while left:
        level = budget / sum(weight[s] for s in left)
        over = [s for s in left if weight[s] * level > 2 * sizes[s]]
        for s in over or list(left):
            target[s] = 2.0 * sizes[s] if over else weight[s] * level
            budget -= target[s] if over else 0
            left.discard(s)
    for s in order:
        own = out[out.source_size == sizes[s]]
        taken, t = (own["size"] * own.copies).sum(), own.target.iloc[0]
        reach = {0}
        for x in own["size"]:
            reach |= {a + x for a in reach}
        base = sizes[s] * (round(t) >= sizes[s])
        assert abs(t - target[s]) < 1e-6 and taken == base + max(a for a in reach if a <= round(t) - base)
    assert out.copies.max() <= 2 and mix(none, keep=["doc_id"]).count() == 0
    r = random.Random(5)
    for _ in range(60):
        s = np.array(sorted(r.sample(range(1, 60), 6)))
        c = np.array([r.randrange(1, 5) for _ in s])
        budget = r.randrange(0, int((s * c).sum()) + 1)
        reach = {0}
        for x, n in zip(s, c):
            reach = {a + int(x) * k for a in reach for k in range(n + 1)}
        taken = fit(s, c, budget)
        assert (taken <= c).all() and (taken >= 0).all() and (taken * s).sum() == max(a for a in reach if a <= budget)
    for _ in range(200):  # long documents: sums as the bits of a number
        s = np.array(sorted(r.sample(range(1000, 30001), r.randrange(1, 7))))
        c = np.array([r.randrange(1, 5) for _ in s])
        budget = r.randrange(0, int((s * c).sum()) + 1)
        sums = 1
        for x, n in zip(s, c):
            for _ in range(n):
                sums |= sums << int(x)
        taken = fit(s, c, budget)
        assert (taken <= c).all() and (taken >= 0).all() and (taken * s).sum() == (sums & ((1 << budget + 1) - 1)).bit_length() - 1


def test_mixing_long_documents():
    """Budgets far beyond the knapsack's window: the best sum of few long documents, of many as good as the budget."""
    import itertools

    from busframe.llm.mixing import WINDOWS, fit

    r = random.Random(8)
    for n in (1, 2, 7, 12, 14):
        sizes = np.array(sorted(r.randrange(2 << 20, 3 << 22) for _ in range(n)))
        budget = int(sizes.sum() * r.uniform(0.3, 0.8))
        best = max(s for k in range(n + 1) for c in itertools.combinations(sizes.tolist(), k) if (s := sum(c)) <= budget)
        assert int((fit(sizes, np.ones(n, "int64"), budget) * sizes).sum()) == best
    sizes, counts = np.array([WINDOWS[-1] + 1, WINDOWS[-1] + 7, 5 * WINDOWS[-1]]), np.array([6, 5, 4])
    for budget in (7 * WINDOWS[-1], 20 * WINDOWS[-1] + 40, 30 * WINDOWS[-1]):
        taken = fit(sizes, counts, budget)
        assert (taken <= counts).all() and int((taken * sizes).sum()) == max(s for c in itertools.product(*[range(x + 1) for x in counts]) if (s := int((np.array(c) * sizes).sum())) <= budget)
    sizes = np.array(sorted({r.randrange(5 << 20, 9 << 22) for _ in range(300)}))
    counts = np.array([r.randrange(1, 4) for _ in sizes])
    budget = int((sizes * counts).sum() * 0.6)
    taken = fit(sizes, counts, budget)
    assert (taken <= counts).all() and 0 <= budget - int((taken * sizes).sum()) < 10


def test_kneser_ney(spark, docs, none):
    from busframe.llm.common import Scratch
    from busframe.llm.kneser_ney import _pack, _unpack, classify, grams, model, probabilities

    assert _unpack(_pack(odd := ["a\0b", "", "\U0001F600 \uD800", "é"])) == odd
    assert not set(grams(["\U0001F600"])[0].tolist()) & set(grams(["\u0601"])[0].tolist()) and grams(odd)[1].tolist() == [3, 0, 4, 1]
    texts = ["abra cadabra", "abracadabra!", "a bra"]
    scratch = Scratch(spark, "test")
    levels = model(scratch, spark.createDataFrame([("=x", t) for t in texts], "lang string, text string"))
    g = np.unique(grams([*texts, "zebra abba"])[0])
    got = {r.gram: r.log_p for r in probabilities(scratch, levels, spark.createDataFrame([("=x", int(x)) for x in g], "lang string, gram long")).collect()}

    full = Counter(grams(texts)[0].tolist())
    counts = {4: full}
    for k in (3, 2, 1):
        counts[k] = Counter(x & ((1 << 16 * k) - 1) for x in counts[k + 1])

    def p(x, k):
        if k == 0:
            return 1 / (len(counts[1]) + 1)
        c, n = counts[k], Counter(min(v, 5) for v in counts[k].values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0.75
        d = {i: (i - (i + 1) * y * n[i + 1] / n[i]) if n[i] else 0.75 for i in (1, 2, 3)}
        d = {i: v if 0 < v < i else 0.75 for i, v in d.items()}
        same = {a: v for a, v in c.items() if a >> 16 == x >> 16}
        low = p(x & ((1 << 16 * (k - 1)) - 1), k - 1)
        if not same:
            return low
        total = sum(same.values())
        return max(c.get(x, 0) - d[min(max(c.get(x, 0), 1), 3)], 0) / total + sum(d[min(v, 3)] for v in same.values()) / total * low

    assert set(got) == set(g.tolist())
    for x in g.tolist():
        assert abs(np.exp(got[x]) - p(x, 4)) < 1e-9
    trusted = docs.where("doc_id < 20").select("doc_id")
    out = classify(docs, trusted.union(trusted)).collect()
    assert len(out) == len(rows())
    by = {r.doc_id: r for r in out}
    assert by[200].perplexity is None and not by[201].keep and by[0].perplexity > 1
    assert classify(none, trusted).count() == 0


def test_chunks_of_a_task_share_a_bucket(spark, tmp_path):
    import os

    from busframe.llm.kneser_ney import own_bucket

    rows = spark.range(40).selectExpr("(id div 4) * 4294967296 + id % 4 + 1 AS chunk", "id div 4 AS task").repartition(10, "task").sortWithinPartitions("task")
    out = own_bucket(rows, 200)
    assert out.select("chunk").distinct().count() == 40 and out.selectExpr("task", "pmod(hash(chunk), 200) AS b").distinct().count() == 10
    out.write.format("parquet").option("path", f"{tmp_path}/t").bucketBy(200, "chunk").saveAsTable("busframe_test_buckets")
    files = [f for f in os.listdir(tmp_path / "t") if f.endswith(".parquet")]
    spark.sql("DROP TABLE busframe_test_buckets")
    assert len(files) == 10  # one a task and bucket, of 10 tasks' 200 buckets


def test_language(spark, docs, none):
    from busframe.llm.langid import UNKNOWN, predict, train

    en, de = "the cat sat on the mat and was there", "der Hund und die Katze sind nicht da"
    teach = spark.createDataFrame([(i, (en, de)[i % 2][i % 7 :], ("en", "de")[i % 2]) for i in range(40)] + [(50, None, "en"), (51, "x", None)], "doc_id long, text string, lang string")
    m = train(teach)
    assert m.languages == ["de", "en"]
    ask = spark.createDataFrame([("THE MAT WAS there",), ("Die Katze und der",), (None,), ("123 !?",), ("",)], "text string")
    assert [r.lang_pred for r in predict(ask, m, keep=["text"]).collect()] == ["en", "de", UNKNOWN, UNKNOWN, UNKNOWN]
    out = predict(docs, m, keep=["doc_id", "text"]).collect()
    assert len(out) == len(rows()) and all(0 <= r.score <= 1 for r in out)
    assert predict(none, m, keep=["doc_id"]).count() == 0
    assert {r.lang_pred for r in predict(docs, train(teach.limit(0)), keep=["doc_id"]).collect()} == {UNKNOWN}


def _grams(text):
    """Buckets of a text's n-grams, one by one."""
    from busframe.llm.langid import BUCKETS, ORDERS

    said = " " + "".join(c if c.isalpha() else " " for c in (text or "").lower()) + " "
    kept = [c for i, c in enumerate(said) if c != " " or not i or said[i - 1] != " "]
    out = []
    for order in ORDERS:
        for i in range(len(kept)):
            h = order * 0x9E3779B1 & 0xFFFFFFFF
            for j in range(order):
                h = (h ^ ord(kept[i + j] if i + j < len(kept) else " ")) * 0x85EBCA6B & 0xFFFFFFFF
                h ^= h >> 15
            out.append(h & BUCKETS - 1)
    return out


@pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_language_held_out(spark):
    """Against naive Bayes by plain loops, and how often held-out labels are met."""
    import math

    from busframe.llm.langid import BUCKETS, held_out, predict, train, train_fold

    data = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    longest = data.agg(F.max("doc_id")).first()[0]
    odd = [(longest + 1, "ß漢字 " * 40_000, None), (longest + 2, "Iİ ı", None), (longest + 3, "a" * 300_000, None)]
    data = data.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string")).withColumns({"lang_pred": F.lit("x"), "score": F.lit(9)})
    model = train(train_fold(data))
    found = {r.doc_id: r for r in predict(data.repartition(5), model, keep=["doc_id", "score"]).collect()}
    assert found.keys() == {r.doc_id for r in data.select("doc_id").collect()}
    rows_ = data.withColumn("held", held_out()).collect()
    counts, docs_ = {}, Counter()
    for r in rows_:
        if not r.held and r.lang is not None and r.text is not None:
            counts.setdefault(r.lang, Counter()).update(_grams(r.text))
            docs_[r.lang] += 1
    assert model.languages == sorted(counts)
    log = {x: {g: math.log((n + 0.5) / (c.total() + 0.5 * BUCKETS)) for g, n in c.items()} for x, c in counts.items()}
    none_ = {x: math.log(0.5 / (c.total() + 0.5 * BUCKETS)) for x, c in counts.items()}
    hit = total = 0
    for r in rows_:
        said = _grams(r.text)
        best = {x: math.log(docs_[x] / docs_.total()) + sum(log[x].get(g, none_[x]) for g in said) for x in counts}
        first, second = sorted(best.values(), reverse=True)[:2]
        if any(c.isalpha() for c in r.text or "") and first - second > 0.1:
            assert found[r.doc_id].lang_pred == max(best, key=best.get)
            assert len(said) > 10_000 or found[r.doc_id].score == pytest.approx(1 / sum(math.exp(v - first) for v in best.values()), abs=1e-3)
        if r.held and r.lang is not None and any(c.isalpha() for c in r.text or ""):
            hit, total = hit + (found[r.doc_id].lang_pred == r.lang), total + 1
    assert total > 20 and hit >= 0.95 * total
    alone = {r.doc_id: r for r in predict(data.repartition(40), model, keep=["doc_id"]).collect()}
    assert all(alone[i].lang_pred == found[i].lang_pred and abs(alone[i].score - found[i].score) < 1e-9 for i in found)  # whatever its neighbours


def sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def linked(items):
    """Smallest id reachable, by all pairs."""
    s = [sets(t) for _, t in items]
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(s)):
        for j in range(i):
            both = len(s[i] & s[j])
            if s[i] and 100 * both >= 75 * (len(s[i]) + len(s[j]) - both):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(s)):
        groups.setdefault(find(i), []).append(i)
    out = []
    for g in groups.values():
        least = min((items[i][0] for i in g if items[i][0] is not None), default=None)
        out += [(items[i][0], len(s[i]), least) for i in g]
    return Counter(out)


def test_jaccard(spark, docs, none):
    from busframe.llm.jaccard import components

    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in components(docs).collect())
    assert got == linked([(a, t) for a, t, *_ in rows()])
    assert components(none).count() == 0
    r = random.Random(9)
    items, words = [], [f"v{i}" for i in range(300)]
    for g in range(6):  # families whose members differ by a few words, on both sides of the threshold
        base = [r.choice(words) for _ in range(r.choice([6, 30, 90]))]
        for _ in range(9):
            t = list(base)
            for _ in range(r.randrange(0, 5)):
                t[r.randrange(len(t))] = r.choice(words)
            items.append((len(items), " ".join(t)))
    got = Counter((x.doc_id, x.n_shingles, x.component_id) for x in components(spark.createDataFrame(items, "doc_id long, text string")).collect())
    assert got == linked(items)


@pytest.mark.parametrize("hot_rows, part_bytes", [(1 << 14, 1 << 23), (16, 4000)])
def test_jaccard_large_groups(spark, hot_rows, part_bytes):
    """Tiles cut into blocks and clusters cut into parts lose no link of a large group of near copies."""
    from busframe.llm.jaccard import groups

    r = random.Random(4)
    base, words = [f"b{i}" for i in range(60)], [f"v{i}" for i in range(50)]
    items = []
    for i in range(90):
        t = list(base)
        for _ in range(r.randrange(0, 4)):
            t[r.randrange(len(t))] = r.choice(words)
        items.append((500 - i, " ".join(t + base[: r.randrange(0, 12)])))
    items += [(700 + i, " ".join(r.choice(words) for _ in range(40))) for i in range(20)]
    docs = spark.createDataFrame(items, "doc_id long, text string").repartition(5)
    found = groups(docs, hot_rows=hot_rows, part_bytes=part_bytes)
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in found.collect()) == linked(items)


def test_jaccard_tiles_are_linear(spark):
    """Rows of a tile's blocks, of near copies: twice the tile, whatever its size; what lies outside meets all."""
    from busframe.llm import jaccard

    for n in (2000, 10_000):
        rows = spark.range(n).selectExpr("7L AS token", "id AS node", "cast(100 + id % 3 AS int) AS n").unionByName(spark.range(5).selectExpr("8L AS token", "id AS node", "100 AS n"))
        hot = jaccard.hot_tiles(rows, 100)
        assert [tuple(r) for r in hot.collect()] == [(7, n // 100)] and jaccard.cut_tiles(rows, hot).count() == 2 * n + 5
        most = jaccard.cut_tiles(rows, hot).where("token = 7").groupBy("block").count().agg(F.max("count")).first()[0]
        assert most < 200
        roots = spark.range(n).selectExpr("id AS node", "0L AS root")
        assert jaccard.open_tiles(rows, hot, roots, 100).count() == 0
        some = jaccard.open_tiles(rows, hot, roots.where("node >= 30"), 100)  # 30 nodes without links ask all parts, all rows are told once
        assert some.select("node").distinct().count() == n and some.count() <= 30 * n // 100 + n
        met = some.groupBy("block").agg(F.collect_set("node").alias("x")).collect()
        assert len(set().union(*[set(r.x) for r in met if 1 in r.x])) == n


def test_jaccard_long_texts(spark):
    """Sets with more tokens than a signature has bits."""
    from busframe.llm.jaccard import components

    r = random.Random(5)
    a = [f"w{r.randrange(10**6)}" for _ in range(20000)]
    b = [w if r.random() > 0.02 else "x" for w in a]
    c = [w if r.random() > 0.10 else "x" for w in a]
    items = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c)), (4, " ".join(a[:15500])), (5, " ".join(a[:14000]))]
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in components(spark.createDataFrame(items, "doc_id long, text string")).collect()) == linked(items)


def test_chat(spark):
    from busframe.llm.chat import format_replies, read_back, thread

    tree = [("t", 1, None, "user", "q # <a>", None), ("t", 2, 1, "assistant", "x\\0", 1.0), ("t", 3, 1, "assistant", "better </turn>\n### user: ", 2.0), ("t", 4, 3, "user", None, 0.0), ("t", 5, 4, "assistant", "é", 0.5), ("u", 1, 9, "a: b", "orphan", 1.0), (None, 1, None, None, "null tree", 0.0), ("c", 1, 2, "user", "cycle", 0.0), ("c", 2, 1, "user", "cycle", 0.0)]
    m = spark.createDataFrame(tree, "tree_id string, msg_id long, parent_id long, role string, text string, score double")
    out = {(r.tree_id, r["rank"]): r for r in read_back(format_replies(m, branches=None)).collect()}
    assert set(out) == {("t", 1), ("t", 2), ("u", 1), (None, 1)}
    best = out["t", 1]
    assert [tuple(x) for x in best.turns] == [("user", "q # <a>"), ("assistant", "better </turn>\n### user: "), ("user", ""), ("assistant", "é")]
    assert best.loss_text == "better </turn>\n### user: é" and best.path_score == 2.5
    assert [tuple(x) for x in out["u", 1].turns] == [("a: b", "orphan")] and out["t", 2].leaf_id == 2
    rows = spark.createDataFrame([(1, None, "b", "last"), (1, 0, "a", "first"), (1, 0, "a", "first"), (None, 1, None, None)], "conv_id long, turn long, role string, text string")
    got = {r.tree_id: [x.text for x in r.turns] for r in read_back(format_replies(thread(rows))).collect()}
    assert got == {1: ["first", "first", "last"], None: [""]}
    assert format_replies(thread(rows.limit(0))).count() == 0


def test_chat_clashing_columns(spark):
    from busframe.llm.chat import format_replies, read_back, thread

    long_text = "long </turn>\n### \\ " * 50_000
    d = spark.createDataFrame([(1, 0, "user", long_text, "p", 1, "s"), (1, 1, "assistant", "ok", "p", 1, "s")], "conv_id long, turn long, role string, text string, path string, rank int, step string")
    r = read_back(format_replies(thread(d))).first()
    assert [tuple(x) for x in r.turns] == [("user", long_text), ("assistant", "ok")] and r.loss_text == "ok"


def test_many_branches(spark):
    """A tree of one message with very many replies, and of a long line beside it: every leaf is a path, ranked by score."""
    from busframe.llm.chat import format_replies, read_back

    n = 3000
    rows = [("t", 0, None, "user", "root", 0.0)] + [("t", i, 0, "assistant", f"reply {i}", float(i % 1000)) for i in range(1, n)] + [("t", n + i, n + i - 1 if i else 0, "ua"[i % 2], f"m{i}", 0.0) for i in range(40)]
    m = spark.createDataFrame(rows, "tree_id string, msg_id long, parent_id long, role string, text string, score double")
    out = read_back(format_replies(m, branches=None)).collect()
    assert len(out) == n and {r.leaf_id for r in out} == {*range(1, n), n + 39}
    by = {r.leaf_id: r for r in out}
    assert [tuple(x) for x in by[17].turns] == [("user", "root"), ("assistant", "reply 17")] and len(by[n + 39].turns) == 41
    best = [r.path_score for r in sorted(out, key=lambda r: r["rank"])]
    assert best == sorted(best, reverse=True)


def test_long_thread(spark):
    from busframe.llm.chat import format_replies, read_back, thread

    rows = spark.createDataFrame([(1, i, ("user", "assistant")[i % 2], f"m{i}") for i in range(150)], "conv_id long, turn long, role string, text string")
    r = read_back(format_replies(thread(rows))).first()
    assert [x.text for x in r.turns] == [f"m{i}" for i in range(150)] and r.loss_text == "".join(f"m{i}" for i in range(1, 150, 2))


def brute_dedup(texts, n=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + n] for d in data for i in range(len(d) - n + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - n + 1):
            if seen[d[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((len(d), sum(gone), spans, bytes(x for x, g in zip(d, gone) if not g)))
    return Counter(out)


@pytest.mark.parametrize("hot", [4096, 2])
def test_suffix_dedup(spark, docs, none, monkeypatch, hot):
    from busframe.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    r = random.Random(4)
    say = lambda n: "".join(r.choice("ab é") for _ in range(n))
    passage = say(420)
    texts = [t for _, t, *_ in rows()] + [say(r.randrange(0, 300)) + passage[r.randrange(0, 150) : r.randrange(250, 420)] + say(r.randrange(0, 300)) for _ in range(12)] + [passage + passage, "ab" * 500]
    d = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_bytes int").repartition(3)
    got = Counter((x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in suffix_dedup.dedup(d, keep=["doc_id", "n_bytes"]).collect())
    assert got == brute_dedup(texts)
    assert suffix_dedup.dedup(none, keep=["doc_id"]).count() == 0


def test_suffix_compare_blocks(monkeypatch):
    """A suffix array is of BLOCK bytes and a group at most, however many rows come in a batch; repeats are those of one array for all."""
    import pyarrow as pa

    from busframe.llm import suffix_dedup as S

    r = random.Random(11)
    groups = [[r.randbytes(r.randrange(100)) + core + r.randbytes(r.randrange(100)) for _ in range(r.randrange(1, 4))] for core in (r.randbytes(r.choice([150, 230])) for _ in range(4000))]
    rows = [(a, 10 * a + i, 7, x) for a, g in enumerate(groups) for i, x in enumerate(g) if len(x) >= S.LENGTH]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["anchor", "key", "first", "segment"])
    sizes, own = [], S.repeated
    monkeypatch.setattr(S, "repeated", lambda text, wanted: (sizes.append(len(text)), own(text, wanted))[1])
    found = lambda: {tuple(x.values()) for b in S._compare(iter([batch.slice(0, 5000), batch.slice(5000)])) for x in b.to_pylist()}
    got = found()
    assert sum(sizes) == sum(len(x[3]) for x in rows) > 4 * S.BLOCK and max(sizes) < S.BLOCK + 2000
    monkeypatch.setattr(S, "BLOCK", 1 << 30)
    assert got == found() and len(got) > 1000


def test_suffix_array():
    from busframe.llm import suffix_dedup as S

    r = random.Random(1)
    for _ in range(20):
        b = bytes(r.choice(range(97, 97 + r.choice([1, 2, 26]))) for _ in range(r.choice([1, 2, 300, 900])))
        t = np.frombuffer(b, "u1")
        order = S.suffix_array(t, S._words(t)).tolist()
        cut = [b[i : i + S.LENGTH] for i in order]
        assert sorted(order) == list(range(len(b))) and cut == sorted(cut)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = spark.createDataFrame(rows(), DOCS).select(*corpus_pipeline.COLUMNS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        counts.append(at.count())
        assert name == "packing" or at.columns == corpus_pipeline.COLUMNS
        if name == "near_duplicates":
            ids = [x.doc_id for x in at.collect()]
            assert ids.count(100) == 1 and 101 not in ids and 102 not in ids and len(ids) == len(set(ids))
        if name == "mix_sources":
            total = at.agg(F.sum(F.length("text"))).first()[0]
            assert total > 0
    assert counts[0] < len(rows()) and counts[-1] > 0


@pytest.mark.parametrize("rows_", [[], [(None, None, None, None, None), (None, None, None, None, None)]])
def test_pipeline_without_texts(spark, tmp_path, rows_):
    """An empty table, and one of nulls alone, go through all stages."""
    import corpus_pipeline

    spark.createDataFrame(rows_, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and "sequence_id" in out.columns


def test_near_duplicates_ids(spark):
    from corpus_pipeline import COLUMNS, near_duplicates

    r = random.Random(8)
    a, b, c, d = (" ".join(f"w{r.randrange(999)}" for _ in range(90)) for _ in range(4))
    near = lambda t: t + " more"
    items = [(3, a), (5, near(a)), (5, b), (None, c), (None, near(c)), (None, near(a)), (7, d), (7, "only this"), (8, None), (None, None), (None, None), (9, " ")]
    docs = spark.createDataFrame([(i, t, "a", "s", 1) for i, t in items], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(x.doc_id, x.text) for x in near_duplicates(spark, docs, "").select(*COLUMNS).collect()]
    alone = [x for x in got if x not in ((None, c), (None, near(c)))]
    assert len(got) == len(alone) + 1
    assert Counter(alone) == Counter([(3, a), (5, b), (7, d), (7, "only this"), (8, None), (None, None), (9, " ")])
