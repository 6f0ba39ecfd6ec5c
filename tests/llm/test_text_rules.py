"""Quality rules, language identification, URL rules, page extraction and chat windows against brute force."""
import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from quayside.llm import bpe, chat, html_extract, lang_id, quality_rules, url_rules

BYTE = public_tokenizers.path("byte_bpe_50k.json")


# --- quality -------------------------------------------------------------------------------------------------------

def brute_base(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated),
            len(words) < 50 or 100 * len(repeated) > 50 * len(words))


def test_base_features(spark):
    rng = random.Random(1)
    words = ["a", "b", "Éa", "#x", "<|>", "😀", "c\xa0d", "zz!"]
    texts = [" ".join(rng.choices(words[:k], k=n)) for k in (1, 2, 4, 8) for n in (0, 1, 2, 3, 4, 5, 49, 50, 51, 400)]
    texts += [None, "", " \t\n\x0b\f\r ", "\n\n", "x\nx\n x\nx", "\x1cx\x1c y", "one two three one two three", "a a a", "a\n\na\n \n a"]
    texts += ["\n".join(rng.choices(["same line", "other", "", " "], k=60)), "w " * 30000]
    df = spark.createDataFrame([(i, t, None, 9, True) for i, t in enumerate(texts)],
                               "doc_id long, text string, lang string, n_words int, kept boolean")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_rules.quality(df, labels).collect()}
    for i, t in enumerate(texts):
        want = brute_base(t)
        assert tuple(got[i])[1:7] == want, (i, t)
        assert got[i].kept is not want[5]  # without labels only the base check rejects
    kept = quality_rules.keep_good(df, labels)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, t in enumerate(texts) if not brute_base(t)[5]]
    assert quality_rules.quality(df.limit(0), labels).collect() == []


@pytest.mark.parametrize("n,k", [(10, 0), (10, 1), (1000, 3), (1000, 10), (200_000, 2000), (50, 0), (5, 5)])
def test_binomial_tail(spark, n, k):
    from pyspark.sql import functions as F
    p = 0.0125
    exact = math.log(sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p)
                                  + (n - i) * math.log1p(-p)) for i in range(k + 1)))
    got = spark.range(1).select(quality_rules.log_binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
    assert got == pytest.approx(exact if k <= p * n else 0.0, rel=1e-6, abs=1e-9)


def test_cutoffs_hold_the_risk(spark):
    """Junk is caught where labels certify a cutoff; a stratum with too few labels rejects nothing."""
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice(["plain", "words", "of", "text", "again", "more"]) + str(rng.randint(0, 99)) for _ in range(60))
    junk = lambda: " ".join(w + "$$$" for w in good().split())
    rows, labels = [], []
    for lang, n in (("en", 1500), ("xx", 30), (None, 1500)):
        for _ in range(n):
            bad = rng.random() < 0.2
            rows.append((len(rows), junk() if bad else good(), lang))
            labels.append((len(labels), 0 if bad else 1))
    labels += [(0, labels[0][1]), (None, 1), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {r.doc_id: r.kept for r in quality_rules.quality(df, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    for i, text, lang in rows:
        assert got[i] is (lang == "xx" or "$$$" not in text)
    # strata beyond the bound share one: all rows are then judged by one set of cutoffs
    shared = quality_rules.quality(df, spark.createDataFrame(labels, "doc_id long, quality int"), max_strata=1)
    assert {r.kept for r in shared.collect() if "$$$" in rows[r.doc_id][1]} == {False}


def metric_rows(stratum, good, bad, junk, **clean):
    """Labelled rows of metrics: ``good`` and ``bad`` documents, the bad ones with the metrics ``junk``."""
    base = {"symbol_ratio": 0.0, "bang_ratio": 0.0, "dup_line_ratio": 0.0, "mean_word_chars": 5.0, **clean}
    return [(stratum, k < good, *({**base, **(junk if k >= good else {})}[m] for m in quality_rules.CUTOFFS)) for k in range(good + bad)]


METRICS = "stratum_key string, good boolean, symbol_ratio double, bang_ratio double, dup_line_ratio double, mean_word_chars double"


def test_joint_cutoffs_need_few_labels(spark):
    """The rules of a stratum share one risk: 321 good labels in one of four languages certify a clear separation, with long
    words of good documents in the way of the fixed path too; 60 do not among four."""
    rows = []
    for lang, n in (("es", 321), ("de", 120), ("fr", 321), ("xx", 60)):
        rows += metric_rows(lang, n, 32, {"symbol_ratio": 0.35}, **({"mean_word_chars": 40.0} if lang == "fr" else {}))
    got = {r.stratum: r for r in quality_rules.fit(spark.createDataFrame(rows, METRICS)).collect()}
    assert got["es"].c_symbol_ratio == 0.3 and got["fr"].c_symbol_ratio == 0.3 and got["fr"].c_mean_word_chars is None
    assert got["de"].c_symbol_ratio == 0.3 and "xx" not in got


def test_joint_certificates_hold_the_risk_together(spark):
    """Good documents that several rules reject a little each count together: no certificate lets them all through."""
    rows = []
    for m, at in (("symbol_ratio", 3.0), ("bang_ratio", 2.0), ("dup_line_ratio", 0.9), ("mean_word_chars", 50.0)):
        rows += metric_rows("en", 0, 100, {m: at}) + [("en", True, *r[2:]) for r in metric_rows("en", 0, 20, {m: at})]
    rows += metric_rows("en", 920, 0, {})
    got = quality_rules.fit(spark.createDataFrame(rows, METRICS)).collect()
    assert len(got) == 1 and 1 <= sum(c is not None for c in got[0][1:]) <= 2  # 20 of 1000 each: four together are 0.08


@pytest.mark.parametrize("n,log_error", [(10, -3.0), (59, -3.0), (100, -3.0), (321, -10.8), (5000, -9.0), (100, -4.7)])
def test_most_false_is_the_last_that_passes(spark, n, log_error):
    from pyspark.sql import functions as F
    tails = [math.log(sum(math.comb(n, i) * 0.05 ** i * 0.95 ** (n - i) for i in range(k + 1))) for k in range(n // 20 + 1)] if n < 1000 else None
    got = spark.range(1).select(quality_rules.most_false(F.lit(n).cast("long"), 0.05, F.lit(log_error))).first()[0]
    if tails:
        assert got == max((k for k, t in enumerate(tails) if t <= log_error), default=-1)
    else:
        tail = lambda k: spark.range(1).select(quality_rules.log_binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), 0.05)).first()[0]
        assert tail(got) <= log_error < tail(got + 1)


def test_every_language_is_a_stratum(spark):
    """A language beyond the 64 best labelled keeps its own cutoffs: its long words are no reason to lose its good documents."""
    rows = []
    for k in range(70):
        junk = {"mean_word_chars": 40.0} if k < 69 else {"symbol_ratio": 3.0}
        rows += metric_rows(f"l{k:02}", 301 if k < 69 else 300, 10, junk, **({"mean_word_chars": 40.0} if k == 69 else {}))
    got = {r.stratum: r for r in quality_rules.fit(spark.createDataFrame(rows, METRICS)).collect()}
    assert len(got) == 70
    assert got["l69"].c_mean_word_chars is None and got["l69"].c_symbol_ratio == 2.0
    assert all(got[f"l{k:02}"].c_mean_word_chars == 30.0 for k in range(69))
    long = lambda: " ".join(rng.choice("abcdef") * 40 + str(rng.randint(0, 999)) for _ in range(60))
    plain = lambda: " ".join("word" + str(rng.randint(0, 999)) for _ in range(60))
    rng = random.Random(5)
    docs = [(f"l{k:02}", "x", 1) for k in range(64) for _ in range(170)]  # 64 better labelled languages
    docs += [(f"l{k}", plain() if i < 150 else long(), int(i < 150)) for k in range(64, 69) for i in range(165)]
    docs += [("l69", long(), 1)] * 10
    df = spark.createDataFrame([(i, text, lang) for i, (lang, text, _) in enumerate(docs)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, q) for i, (_, _, q) in enumerate(docs)], "doc_id long, quality int")
    judged = quality_rules.quality(df, labels).where(f"doc_id >= {len(docs) - 10}").collect()
    assert [r.kept for r in judged] == [True] * 10


# --- languages -----------------------------------------------------------------------------------------------------

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["ster", "öm", "gren", "ung"], "cc": ["éau", "lle", "oi", "ment"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def test_languages(spark):
    rng = random.Random(3)
    rows = [(i, sentence(rng, lang, rng.choice([30, 80, 5000 if i % 50 == 0 else 60])), lang, "und") for i in range(450)
            for lang in [rng.choice(sorted(SYLLABLES))]]
    odd = [(1000, None, "aa", ""), (1001, "", "aa", ""), (1002, "123 ... 456", "bb", ""), (None, rows[0][1], "aa", ""),
           (1003, rows[1][1].upper(), None, ""), (1004, "$$$ " * 100, None, ""), (0, *rows[0][1:])]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, lang_pred string").repartition(4)
    got = lang_id.predictions(df).collect()
    assert len(got) == len(rows) + len(odd)
    import zlib
    of = {r.doc_id: r for r in got}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.lang_pred in {*SYLLABLES, "und"} for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 450]
    assert sum(r.lang_pred == rows[r.doc_id][2] for r in held) >= 0.99 * len(held) and len(held) > 60
    assert [of[i].lang_pred for i in (1000, 1001, 1002, 1004)] == ["und"] * 4 and not of[1000].accepted
    assert of[1003].lang_pred == rows[1][2]
    kept = lang_id.keep_identified(df)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.accepted)
    assert lang_id.predictions(df.limit(0)).collect() == []
    nothing = lang_id.predictions(df.withColumn("lang", df.lang.substr(9, 1)).where("doc_id = 2").selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert [(r.lang_pred, r.accepted) for r in nothing.collect()] == [("und", False)]


def test_every_language_is_learned(spark, monkeypatch):
    rng = random.Random(14)
    names = [f"l{k:02}" for k in range(70)]
    syllables = {name: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=4)) for _ in range(6)] for name in names}
    text = lambda name: " ".join("".join(rng.choices(syllables[name], k=2)) for _ in range(40))
    rows = [(len(names) * i + k, text(name), name) for k, name in enumerate(names) for i in range(8 if k < 64 else 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.learn(df)
    assert sorted(model) == names
    asked = spark.createDataFrame([(k, text(name)) for k, name in enumerate(names)], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in lang_id.identify(asked, model).collect()} == dict(enumerate(names))
    monkeypatch.setattr(lang_id, "MODEL_SNIPPETS", 10)  # the total bound shortens the samples, not the list of languages
    assert sorted(lang_id.learn(df)) == names


def test_prediction_ignores_lang_source_and_id(spark):
    rng = random.Random(4)
    texts = [sentence(rng, lang, 40) for lang in ("aa", "bb", "cc")]
    model = {lang: "\n".join(sentence(rng, lang, 60) for _ in range(50)).encode() for lang in SYLLABLES}
    df = spark.createDataFrame([(i, t, x) for i, t in enumerate(texts * 2) for x in ("aa", None)], "doc_id long, text string, lang string")
    assert len({(texts[r.doc_id % 3], r.lang_pred) for r in lang_id.identify(df, model).collect()}) == 3


# --- URLs ----------------------------------------------------------------------------------------------------------

def brute_url(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split("[/?#]", rest, maxsplit=1)[0].translate({c: c + 32 for c in range(65, 91)})
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    fit = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, verdict, rule = max(fit, default=(0, "allow", None))
    return host, path, rule, verdict


RULE_SETS = [url_rules.RULES, (), (("block", "com", "/"), ("allow", "a.com", "/"), ("block", "b.a.com", "/x"), ("allow", "b.a.com", "/x/y"),
                                   ("block", "a.com", "/x"), ("block", "zz", ""), ("allow", "zz", ""), ("block", "c-d.com", "/"))]


@pytest.mark.parametrize("rules", RULE_SETS)
@pytest.mark.parametrize("sweeps", [1, 5])
def test_urls_against_every_rule(spark, rules, sweeps):
    rng = random.Random(6)
    hosts = ["net", "example.net", "blog.example.NET", "notexample.net", "a.com", "b.a.com", "x.b.a.com", "aa.com", "c-d.com", "c.com",
             "example.com", "x.example.com", "org", "q.org", "zz", "a.zz", "", "net.", "..", "exämple.net", "a.com:80", "u@a.com"]
    paths = ["", "/", "/en/", "/en", "/de/x", "/fr/?q=/x", "/x", "/x/y/z", "?a=://b", "#/en/", "/x#y", "/X/y", "/\n/x"]
    urls = [f"{rng.choice(['http', 'https', ''])}://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme/x", "a://b://c/d", "://"]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)] + [(None, urls[3], "x", "y"), (3, urls[3], "x", "y")],
                               "page_id long, url string, host string, stack string").repartition(3)
    got = url_rules.judge(df, url_rules.rule_table(spark, rules), sweeps).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        assert tuple(r)[1:] == brute_url(urls[3 if r.page_id is None else r.page_id], rules), r
    assert url_rules.judge(df.limit(0), url_rules.rule_table(spark, rules), sweeps).collect() == []


# --- pages ---------------------------------------------------------------------------------------------------------

PAGES = {
    "<p>": "", "": "", "plain &amp; text &lt;b&gt;": "plain & text <b>",
    "<body><nav>Menu</nav><article><h1>T</h1><p>One<p>two <b>bo<i>ld</b> x</i> &nbsp; y<br>z<ul><li>i<li>j</ul></article><footer>f</footer>":
        "T One two bold x y z i j",
    "<article><header><h1>Head</h1><p>by line</p></header>Text<div class='share-bar'>Share</div><section id=comments><article>c</article></section></article>":
        "Head Text",
    "<div class=ad>ad</div><main><div class='content'>a<script>if (a<b) '</p>'</script>b</div><aside>s</aside></main><form>f<input></form>tail": "a b",
    "<body class='has-sidebar'><div id='cookie-notice'>c</div><p>Hi <a href='x>y'>l</a>, <span class=ad>buy</span> now &#65;&#x42; &copy; &amp</p>": "Hi l, now AB © &",
    "<article>one<!-- x <p>no</p> -->two <style>p{}</style><noscript>n</noscript>three": "onetwo three",
    "<article>cut off <b>here</b> <a href=\"unclosed": "cut off here",
    "<ARTICLE>Case <EM>matters</EM> not</ARTICLE><P>after": "Case matters not",
    "<div hidden>h</div><div role=navigation>n</div><div aria-hidden=true>x</div><div style='display: none'>y</div><section>seen</section>": "seen",
    "<article>a</article><div>between</div><article>b</article>": "a b",
    "<svg><text>no</text></svg><p>in<textarea>t</textarea><button>b</button> out</p>": "in out",
    "<article><p class='notice'>n</p><p>body 1 < 2 & 3 > 2</p></article>": "body 1 < 2 & 3 > 2",
}


def test_page_texts(spark):
    rows = [(i, f"https://h{i}.org/", s, "x") for i, s in enumerate(PAGES)]
    rows += [(100, None, None, "x"), (None, "bad", "<article>n</article>", "x"), (0, None, "<article>n</article>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    got = html_extract.extract(df).collect()
    assert len(got) == len(rows)
    want = [*PAGES.values(), "", "n", "n"]
    assert sorted(str((r.page_id, r.url, r.text, r.n_chars)) for r in got) == sorted(
        str((i, u, t, len(t))) for (i, u, _, _), t in zip(rows, want))
    assert html_extract.extract(df.limit(0)).collect() == []


def test_article_text_named_by_common_words_stays():
    text = lambda inside: html_extract.Page(f"<article><p>a</p>{inside}<p>z</p></article>").settled
    for inside in ('<section id="related-work">t</section>', '<div id="search-and-rescue">t</div>', '<p class="social-history">t</p>',
                   '<table class="widgets-sold"><tr><td>t</table>', '<span class="menu-item">t</span>', '<section id="search">t</section>',
                   '<p class="ad-hoc">t</p>', '<code><span class="token comment">t</span></code>'):
        assert text(inside) == "a t z", inside
    for inside in ('<div class="ad">t</div>', '<div class="box cookie-notice">t</div>', '<div class="share-bar">t</div>', '<p class="notice">t</p>',
                   '<div class="comment">t</div>', '<section id="comments">t</section>', '<div class="related-posts">t</div>'):
        assert text(inside) == "a z", inside


def unmarked_site(rng, n):
    """Pages without any marking: three repeated lines around texts of their own."""
    words = [a + b + c for a in "bdfgk" for b in "aeiou" for c in ("rn", "st", "ll", "m", "x")]
    rows, texts = [], []
    for i in range(n):
        text = " ".join(rng.choices(words, k=80))
        texts.append(text)
        rows.append((i, "http://site.org/%d" % i, f"<body><div>Welcome to the site of many things</div><p>{text}</p><div>All rights reserved by us here</div>"
                                                  f"<div>Read more about our terms</div></body>"))
    return rows, texts


def test_suffix_array_removes_what_a_host_repeats(spark):
    rng = random.Random(9)
    rows, texts = unmarked_site(rng, 30)
    copies = [(100 + i, f"http://site.org/c{i}", rows[4][2]) for i in range(3)]  # copies of a page keep its text
    other = [(200, "http://other.org/", rows[5][2])]                            # on another host nothing repeats
    df = spark.createDataFrame(rows + copies + other, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r for r in html_extract.extract(df).collect()}
    assert [got[i].text for i in range(30)] == texts
    assert [got[100 + i].text for i in range(3)] == [texts[4]] * 3
    assert got[200].text.startswith("Welcome to the site") and got[200].n_removed == 0
    assert got[0].n_removed == 18


def test_common_phrases_stay_and_long_passages_go(spark):
    """A short phrase in sentences of a page's own stays; a long passage inside blocks, and short blocks in a row, go."""
    rng = random.Random(12)
    _, texts = unmarked_site(rng, 12)
    passage = " ".join(f"p{k}" for k in range(25))
    rows, want = [], []
    for i, text in enumerate(texts):
        said = f"{text} at the end of the day {text[::-1]}"
        long = f" {passage} and{i}" if i < 3 else ""
        rows.append((i, "http://small.org/%d" % i, f"<ul><li>Home<li>News<li>About us</ul><p>{said}{long}</p>"))
        want.append(said + (f" and{i}" if i < 3 else ""))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert [got[i] for i in range(12)] == want


def test_passage_on_one_percent_of_a_large_host_goes(spark):
    rng = random.Random(13)
    _, texts = unmarked_site(rng, 500)
    advert = "<div>Buy the best garden chairs of this year now</div>"
    df = spark.createDataFrame([(i, "http://large.org/%d" % i, f"<p>{t}</p>{advert if i % 100 == 0 else ''}") for i, t in enumerate(texts)],
                               "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r for r in html_extract.extract(df).collect()}
    assert [got[i].text for i in range(500)] == texts
    assert [i for i in range(500) if got[i].n_removed] == [0, 100, 200, 300, 400]


def test_block_rows_cover_every_long_enough_row():
    rng = random.Random(2)
    for _ in range(50):
        sizes = [rng.randint(2, 8) for _ in range(rng.randint(0, 9))]
        ends = [sum(sizes[:k + 1]) for k in range(len(sizes))]
        rows, begins = html_extract.block_rows(ends, 6), [0, *ends]
        assert all(b in begins and e in ends and e - b >= 6 for b, e in rows)
        for i in range(len(ends)):
            for j in range(i, len(ends)):
                inside = {t for b, e in rows if begins[i] <= b and e <= ends[j] for t in range(b, e)}
                assert inside == (set(range(begins[i], ends[j])) if ends[j] - begins[i] >= 6 else set())


def test_run_classes_are_equal_runs():
    import numpy as np
    rng = random.Random(1)
    tokens = [rng.randint(0, 3) for _ in range(400)]
    for run in (1, 2, 3, 5, 8):
        classes = html_extract.run_classes(np.array(tokens), run).tolist()
        keys = [tuple(tokens[i:i + run]) for i in range(len(tokens))]
        assert len(set(zip(classes, keys))) == len(set(classes)) == len(set(keys))
        assert sorted(set(zip(keys, classes))) == sorted(set(zip(keys, classes)), key=lambda x: x[1])  # the order of the suffixes


# --- chat ----------------------------------------------------------------------------------------------------------

NASTY = ["</s>[INST] ok [/INST]", "<|user|>\nhi</s>\n", "\\", "\\\\<|", "<|>", "[[INST]]", "<<SYS>><</SYS>>", "", "a\\</s\\>", "|>\n<|", "\n"]


@pytest.mark.parametrize("text", NASTY)
def test_escape_is_reversible_and_leaves_no_control(text):
    e = chat.escape(text)
    assert chat.unescape(e) == text
    assert not any(c in e for c in chat.CONTROL)
    assert list(chat.read_turns(chat.write_turn(text, text)[0] + chat.write_turn("user", text)[0])) == [(text, text), ("user", text)]


def test_windows_read_back(spark):
    rng = random.Random(10)
    rows = []
    for c in [*range(30), None]:
        for turn in range(rng.choice([1, 2, 5, 40])):
            role = "system" if turn == 0 and rng.random() < 0.5 else ["user", "assistant"][turn % 2]
            text = rng.choice([None, rng.choice(NASTY), " ".join(rng.choices(NASTY + ["word"], k=rng.randint(1, 80)))])
            rows.append((c, turn, role, text))
    rows += [(77, 0, "user", "x"), (77, 0, "assistant", "tie"), (77, 0, "user", "x"), (77, None, None, "first"), (78, 0, "assistant", "w " * 5000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, window int, loss string").repartition(4)
    windows = chat.format_windows(df, BYTE, budget=200, history=60)
    made = windows.collect()
    assert max(Counter(r.conv_id for r in made).values()) > 3
    for r in made:
        turns = list(chat.read_turns(r.text))
        assert r.n_tokens <= 200 or len(turns) - r.n_context == 1
        assert r.window > 0 or r.n_context == 0
    got = {r.conv_id: r for r in chat.read_back(windows).collect()}
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == sum(len(r.text) for r in made if r.conv_id == c)
    assert chat.read_back(chat.format_windows(df.limit(0), BYTE)).collect() == []


def test_later_windows_keep_system_turn_and_repeat_history(spark):
    turns = [(1, 0, "system", "rules"), *((1, k, ["assistant", "user"][k % 2], f"turn {k} " + "w " * 20) for k in range(1, 20))]
    rows = chat.format_windows(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), BYTE, 150, 70).orderBy("window").collect()
    assert len(rows) > 3
    for r in rows[1:]:
        read = list(chat.read_turns(r.text))
        assert read[0] == ("system", "rules") and r.n_context >= 2
        targets = [chat.unescape(r.text[s.start:s.end]) for s in r.loss]
        assert targets == [t for k, (role, t) in enumerate(read) if role == "assistant" and k >= r.n_context]


def _windows_by_hand(turns, budget, history):
    """Windows of one conversation's ordered (role, text, tokens): (start, context places, new places)."""
    kept = turns[0][2] if turns[0][0] == "system" else 0
    step = max(budget - kept - history, (budget - kept) // 2, 1)
    groups, at, starts = {}, 0, []
    for k, (*_, tokens) in enumerate(turns):
        cell = at // step
        groups.setdefault((cell, at + tokens - cell * step > budget - (kept if cell else 0)), []).append(k)
        starts.append(at)
        at += tokens
    made = []
    for new in groups.values():
        context, room = [], min(history, budget - kept - sum(turns[k][2] for k in new))
        for k in range(new[0] - 1, 0 if kept else -1, -1):
            if turns[k][2] > room:
                break
            room -= turns[k][2]
            context.insert(0, k)
        made.append((new[0], ([0] if kept and new[0] else []) + context, new))
    return sorted(made)


@pytest.mark.parametrize("budget, history", [(150, 70), (60, 0), (40, 200), (1, 1)])
def test_windows_by_prefix_sums_equal_those_by_hand(spark, budget, history):
    rng = random.Random(budget)
    convs = {c: [("system" if k == 0 and c % 2 else ["user", "assistant"][k % 2], rng.choice(["", "</s> a", "b " * rng.randint(1, 60)]))
                 for k in range(rng.choice([1, 3, 30, 90]))] for c in range(8)}
    rows = [(c or None, k, *t) for c, turns in convs.items() for k, t in enumerate(turns)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    count = bpe.loaded(BYTE).count
    expected = []
    for c, turns in convs.items():
        sized = [(role, text, count(role) + count(text) + chat.OVERHEAD) for role, text in turns]
        for start, context, new in _windows_by_hand(sized, budget, history):
            text, loss = "", []
            for k in context + new:
                written, lo, hi = chat.write_turn(*turns[k])
                if k in new and turns[k][0] == "assistant":
                    loss.append((len(text) + lo, len(text) + hi))
                text += written
            expected.append((c, start, text, loss, len(context), sum(sized[k][2] for k in context + new)))
            assert expected[-1][-1] <= budget or len(new) == 1
    got = [(r.conv_id or 0, r.window, r.text, [tuple(s) for s in r.loss], r.n_context, r.n_tokens)
           for r in chat.format_windows(df, BYTE, budget, history).collect()]
    assert sorted(got) == sorted(expected)


def test_a_hot_conversation_is_spread_over_tasks(spark):
    df = spark.range(6000).selectExpr("cast(null as long) as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role",
                                      "concat('turn ', id, ' </s>') as text")
    windows = chat.format_windows(df.repartition(4), BYTE, 100, 20)
    plan = windows._jdf.queryExecution().toString()
    assert "hashpartitioning(cid" in plan and "hashpartitioning(conv_id" not in plan
    assert "MapInArrow" not in plan  # counted once, before
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few
    try:
        spread = windows.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) > 1 and max(r["count"] for r in spread) < sum(r["count"] for r in spread) / 2
    back = chat.read_back(windows).collect()
    assert [(r.conv_id, r.n_turns) for r in back] == [(None, 6000)]


# --- pipeline ------------------------------------------------------------------------------------------------------

def test_pipeline_stages(spark, tmp_dir):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "language", "near_duplicates", "packing"]
    now, left = docs, set(texts)
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, now, sf).write.parquet(f"{tmp_dir}/{n}")
        now = spark.read.parquet(f"{tmp_dir}/{n}")
        assert now.schema == docs.schema
        ids = {r.doc_id for r in now.select("doc_id").collect()}
        assert ids <= left and all(texts[r.doc_id] == r.text for r in now.collect())
        if name == "quality":  # too few labels here to certify a cutoff: the base check decides
            assert ids == {i for i in left if not brute_base(texts[i])[5]}
        left = ids
    from quayside.llm import simhash
    fps = sorted(simhash.fingerprint(texts[i]) for i in left)
    assert min((a ^ b).bit_count() for k, a in enumerate(fps) for b in fps[:k]) > 4
    packed = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == left
