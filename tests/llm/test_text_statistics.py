"""Quality rules, license scans, toxicity, main text and language model against plain Python."""

from __future__ import annotations

import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluicegate.llm import html_text, language_model, licenses, quality, queries, toxicity, trie
from tests.llm.texts import corpus, frame, prose, save

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def same_rows(frame_, expected) -> None:
    key = lambda row: tuple((x is None, x) for x in row)
    assert sorted(map(tuple, frame_.collect()), key=key) == sorted(expected, key=key)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    labels = spark.createDataFrame([(i * 3, 1, int(i % 5 == 0)) for i in range(40)], "doc_id long, quality int, toxic int")
    return save(spark, tmp_path_factory.mktemp("texts"), documents=frame(spark, corpus()), labels=labels)


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    return save(spark, tmp_path_factory.mktemp("none"), documents=frame(spark, []), labels=labels)


def test_quality_measures(spark, folder):
    def measured(text):
        words = WORD.findall(text or "")
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = [line for line in (text or "").split("\n") if WORD.search(line)]
        failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again), failed

    found = queries.op1_quality(spark, folder)
    same_rows(
        found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"),
        [(i, *measured(text)) for i, text in corpus()],
    )
    assert not found.where("base_failed and kept").count()


def expectation(patterns: Counter, rounds: int = 25) -> quality.LabelModel:
    """The label model in plain Python."""
    rules = len(next(iter(patterns)))
    model = quality.revised(0.0, 0.0, [0.0] * 4 * rules)
    for _ in range(rounds):
        share, sums = 0.0, [0.0] * 4 * rules
        for votes, count in patterns.items():
            good, bad = model.good, 1 - model.good
            for vote, g, b in zip(votes, model.on_good, model.on_bad, strict=True):
                at = {quality.REJECT: 0, quality.KEEP: 1}.get(vote)
                good *= 1 - sum(g) if at is None else g[at]
                bad *= 1 - sum(b) if at is None else b[at]
            p = good / (good + bad)
            share += count * p
            for rule, vote in enumerate(votes):
                if vote != quality.ABSTAIN:
                    sums[4 * rule + vote] += count * p
                    sums[4 * rule + 2 + vote] += count * (1 - p)
        model = quality.revised(float(sum(patterns.values())), share, sums)
    return model


def test_label_model_matches_plain_expectation_maximisation(spark):
    patterns = Counter({(1, 1, -1): 500, (1, -1, 1): 300, (0, 0, 0): 60, (0, 0, -1): 40, (-1, 1, 1): 100, (1, 0, 1): 9})
    rows = [votes for votes, count in patterns.items() for _ in range(count)]
    votes = ["a", "b", "c"]
    model = quality.fit_label_model(spark.createDataFrame(rows, "a int, b int, c int"), votes, tolerance=0)
    expected = expectation(patterns)
    assert np.allclose(quality._numbers(model), quality._numbers(expected), rtol=1e-9)
    assert all(x > 0.5 for x in model.accuracies())
    one = spark.createDataFrame([(0, 0, 0), (1, 1, 1)], "a int, b int, c int").withColumn("p", model.posterior(votes))
    assert [round(r.p) for r in one.orderBy("a").collect()] == [0, 1]


def test_junk_goes_and_prose_stays(spark):
    words = [f"w{chr(97 + i % 23)}{chr(97 + i % 19)}{chr(97 + i % 7)}" for i in range(150)]
    good = [(i, " ".join(words[i % 5 :]) + ".") for i in range(400)]
    junk = [(1000 + i, " ".join(f"{w}***" for w in words[i % 40 :])) for i in range(60)]
    found = {r.doc_id: r.good for r in quality.judge(frame(spark, good + junk)).collect()}
    assert all(found[i] for i, _ in good) and not any(found[i] for i, _ in junk)


def test_licenses_count_every_place(spark, folder, tmp_path):
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    texts = [
        "Released UNDER the MIT License. under the mit license", "cc-by-nc cc by nc; CC BY NC", "Apache License, Version 2.0",
        "undermit the mit license", None, "", "plain", "under the mit license " * 300,
    ]
    rows = [*enumerate(texts, 1000), *corpus()]

    def expected(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
        places = [(i, label) for phrase, label in phrases.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        starts = [i for i, _ in places]
        return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))

    folder_ = save(spark, tmp_path, documents=frame(spark, rows))
    found = queries.op9_licenses(spark, folder_)
    same_rows(
        found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"),
        [(i, *expected(text)) for i, text in rows],
    )
    assert found.where("score < 0 or score > 1 or labels is null").count() == 0


def test_license_rules_compile_and_contained_detections_go(spark):
    rules = licenses.rules()
    assert len(rules) > 200
    for rule in rules:
        assert re.compile(rule["pattern"]) and rule["keyword"] in rule["pattern"].replace("(?:", "").replace("?", "")
    texts = ["licensed under the gnu general public license version 3", "the bsd 3 clause license", "gnu gpl"]
    found = {r.doc_id: r for r in licenses.scan(frame(spark, [*enumerate(texts)])).collect()}
    assert found[0].labels == ["gpl-3"]  # the plain gpl inside it goes
    assert found[1].labels == ["bsd-3"]
    assert len(found[0].spans) > 1


def sample_of(parsed, r) -> str:
    """A text that a parsed pattern matches, chosen at random."""
    out = []
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            out.append(chr(value))
        elif name == "NOT_LITERAL":
            out.append("w")
        elif name == "IN":
            out.append(chr(r.choice([v for _, v in value])))
        elif name == "BRANCH":
            out.append(sample_of(r.choice(value[1]), r))
        elif name == "SUBPATTERN":
            out.append(sample_of(value[3], r))
        elif name == "MAX_REPEAT":
            low, high, inner = value
            out += [sample_of(inner, r) for _ in range(r.randint(low, min(high, low + 2)))]
        else:
            assert name == "ASSERT"
    return "".join(out)


def plain_licenses(text: str | None) -> tuple:
    """Detections without any gate, and what containment leaves."""
    words = [w for w in re.split(licenses.NOT_WORD, lower(text or "")) if w]
    line = f" {' '.join(words)} "
    spans = []
    for rule in licenses.rules():
        for found in re.finditer(rule["pattern"], line):
            start = line[: found.start()].count(" ") - 1
            spans.append((start, start + found.group().count(" ") + 1, rule["priority"], rule["rule"], rule["label"], rule["base"]))
    left = [
        s for s in spans
        if not any(o[0] <= s[0] and s[1] <= o[1] and o[2] >= s[2] and o != s and (o[:3] != s[:3] or o[3] < s[3]) for o in spans)
    ]
    base = [s for s in spans if s[5]]
    starts = [s[0] for s in base]
    return (
        len(words),
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({s[4] for s in base})),
        ",".join(sorted({s[4] for s in (*base, *left)})),
        licenses.CONFIDENCE[max((s[2] for s in left), default=0)],
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_license_query_equals_rules_without_gates(spark, tmp_path, seed):
    import random

    r = random.Random(seed)
    texts = [sample_of(re._parser.parse(rule["pattern"]), r) for rule in licenses.rules()]
    texts += [" and ".join(r.sample(texts, 3)).title() for _ in range(60)]
    texts += ["under the MIT License, under the mit\nlicense", "under mit supervision, ruby light, limit", "\u212aelvin \u0130SC license ISC licence"]
    rows = [*corpus(), *enumerate((f"{prose(r, 4)} {t}, {prose(r, 3)}" for t in texts), 2000)]
    found = queries.op9_licenses(spark, save(spark, tmp_path, documents=frame(spark, rows)))
    same_rows(found, [(i, *plain_licenses(t)) for i, t in rows])
    assert len({label for row in found.collect() for label in row.labels.split(",")}) > 50


def test_plain_names_need_the_word_license(spark):
    texts = ["work done under mit supervision", "a book published under ruby light", "under curl", "released under the ISC license", "published under CC0"]
    found = [r.labels for r in licenses.scan(frame(spark, [*enumerate(texts)])).orderBy("doc_id").collect()]
    assert found == [[], [], [], ["isc"], ["cc0"]]


def test_toxicity_learns_words_and_misspellings(spark, tmp_path):
    import random

    r = random.Random(1)
    pool = [f"{a}{b}{c}" for a in ("ta", "re", "mi") for b in ("lo", "ven", "sur") for c in ("n", "dle", "st", "k")]
    def text(bad):
        words = [r.choice(pool) for _ in range(30)]
        for word in bad:
            words.insert(r.randrange(30), word)
        return " ".join(words)

    rows = [(i, text(["zwabbler", "quonkish"] if i % 4 == 0 else [])) for i in range(400)]
    rows += [(400 + i, text(["zwabler", "quonksh"] if i % 2 else [])) for i in range(40)]
    rows += [(900, None), (901, ""), (902, "  ")]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(400)] + [(903, 1, 1), (None, 1, 1), (5, 1, None)]
    folder = save(spark, tmp_path, documents=frame(spark, rows), labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = {x.doc_id: x for x in queries.op5_toxicity(spark, folder).collect()}
    assert len(found) == len(rows)
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(found[i].held_out for i in held)
    assert np.mean([found[i].predicted == (i % 4 == 0) for i in held]) > 0.95
    unseen = [found[400 + i].score for i in range(40)]
    assert min(unseen[1::2]) > max(unseen[0::2]) - 0.05 and np.mean(unseen[1::2]) > np.mean(unseen[0::2]) + 0.2
    assert found[900].score == found[901].score == found[902].score
    again = {x.doc_id: x.score for x in queries.op5_toxicity(spark, folder).collect()}
    assert all(again[i] == found[i].score for i in found)


def test_features_are_character_n_grams():
    data = np.frombuffer(b"Ab c", np.uint8)
    buckets, owners = toxicity.features(data, np.array([0, 4]))
    assert len(buckets) == (2 + 1 + 0) + 1 + 2  # <ab>: two of 3, one of 4; <c>: one of 3; two whole words
    other, _ = toxicity.features(np.frombuffer(b"c aB", np.uint8), np.array([0, 4]))
    assert sorted(buckets) == sorted(other) and not owners.any()


PAGE = """<html><head><title>T</title><script>if (a<b) "</p>"</script></head><body><header><h2>Site</h2></header>
<nav><ul><li><a href=x>One</a></li></ul></nav><div class="ad banner">Buy this now, it is very cheap indeed.</div>
<article><header><h1>Title &amp;
 more</h1></header><p>First  <b>bold</b> text<p>Second&nbsp;one<br>after<aside>note</aside><p>End.<div class=comments><p>Reader says much here</p></div></article>
<form><p>Mail</p></form><footer>&copy; all</footer>"""


LONG = "x" * 900


@pytest.mark.parametrize(
    "page, text",
    [
        (f'<article><p data-x="{LONG} > {LONG}">One.</p></article>', "One."),
        ("<article><p" + "".join(f' a{i}="v > {i}"' for i in range(300)) + ">One.</p></article>", "One."),
        ('<article><p title="the hidden truth">One.</p><p alt="a hidden gem">Two.</p></article>', "One.\nTwo."),
        ('<article><p hidden>No.</p><p class="a hidden">No.</p><p style="display: none">No.</p><p>One.</p></article>', "One."),
        ("<article><p title=it's>One.</p><p title=it's>Two.</p></article>", "One.\nTwo."),
        ('<article><p data-a="class=menu">One.</p><script>if (a<b) x = "</p>";</script><p>Two.</p></article>', "One.\nTwo."),
        ('<article><p>One.</p><p title="open>Two.</p></article>', "One.\nTwo."),
    ],
)
def test_attributes_are_read_as_browsers_do(page, text):
    assert html_text.main_text(page) == text


def test_malformed_pages_take_no_longer():
    for part in ('<a b="><a" ', "<a <a ", '<a x="', "<!-- <p ", "<a b='<a' c="):
        page = part * 60_000
        began = time.monotonic()
        html_text.main_text(page)
        assert time.monotonic() - began < 20


def test_training_rows_are_bounded_by_id_and_features(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda bags: seen.append(len(bags.labels)) or toxicity.Model(np.zeros(toxicity.BUCKETS), 0.0))
    docs = frame(spark, [(1, f"text number {i}") for i in range(300)] + [(2, "good text"), (3, "more text")])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    toxicity.fit(docs, labels, F.lit(True))
    toxicity.fit(docs, labels, F.lit(True), train_features=40)
    toxicity.fit(docs, labels, F.lit(True), train_features=0)
    assert seen[0] == 3 and 0 < seen[1] < 3 and seen[2] == 0


def test_main_text(spark):
    assert html_text.main_text(PAGE) == "Title & more\nFirst bold text\nSecond one\nafter\nEnd."
    body = "".join(f"<p>{'Long sentence of the story. ' * 5}</p>" for _ in range(4))
    menu = "<div><a href=a>Home</a></div><div><a href=b>News</a></div><div><a href=c>Shop</a></div><div><a>More</a></div>"
    plain = html_text.main_text(f"<body>{menu}<div>{body}</div>{menu}<div>tiny</div></body>")
    assert plain == "\n".join(["Long sentence of the story. " * 5][0].strip() for _ in range(4))
    for empty in (None, "", "   ", "<p></p>", "<!-- x", "<script>x", "<div class='ad'>x</div>"):
        assert html_text.main_text(empty) == ""
    pages = spark.createDataFrame(
        [(1, "u", PAGE, "z"), (1, "u", PAGE, "z"), (None, None, None, "z"), (2, "v", "<p>" + "<b" * 3000, "z")],
        "page_id long, url string, html string, text string",
    )
    assert [len(r.text) for r in html_text.extract(pages).where("page_id = 1").collect()] == [len(html_text.main_text(PAGE))] * 2
    assert html_text.extract(pages.limit(0)).count() == 0 and html_text.extract(pages).count() == 4


@pytest.mark.parametrize(
    "page",
    [
        '<div class="content-sidebar-wrap"><main><p>{}</p></main></div>',
        '<div class="sidebar"><main><p>{}</p></main></div>',
        '<div class="main no-sidebar"><p>{}</p></div>',
        '<div id="search-results"><p>{}</p></div>',
        '<div class="legal-article"><p>{}</p></div>',
        '<h1>Terms</h1><div class="page legal"><p>{}</p></div>',
        "<div><button>Buy</div><p>{}</p>",
        "<div><svg><g></g></div><div>{}</div>",
        "<div><noscript><p>No script</p></div><article><p>{}</p></article>",
        "<head><meta name=x><body><p>{}</p>",
    ],
)
def test_main_text_in_wrappers_and_after_unclosed_elements(page):
    text = " ".join(["The story goes on for a while."] * 5)
    assert text in html_text.main_text(page.format(text))


def test_teasers_do_not_stand_in_for_the_article():
    teaser = "<div class='related'><article><p>Another story.</p></article></div>"
    assert html_text.main_text(f"<article><p>The story.</p></article>{teaser}") == "The story."


@pytest.mark.parametrize("power", [1, 6])
def test_successors_are_found_whether_they_lie_evenly_or_not(power):
    r = np.random.default_rng(power)
    context = np.sort(r.integers(0, 40, 4000) ** 2 // 40)
    pairs = np.unique(context * 10**6 + (r.random(4000) ** power * 10**6).astype(np.int64))
    context, word = pairs // 10**6, pairs % 10**6
    held = trie.Level(trie.level(context, word, 41, 10**6))
    asked = np.concatenate((pairs, pairs + 1, pairs - 1, r.integers(0, 41 * 10**6, 3000)))
    asked = asked[(asked >= 0) & (asked < 41 * 10**6)]
    at, begin = held.find(asked // 10**6, asked % 10**6)
    places = {int(p): i for i, p in enumerate(pairs)}
    assert at.tolist() == [places.get(int(p), -1) for p in asked]
    assert (begin == np.searchsorted(context, asked // 10**6)).all()


def test_language_model_matches_plain_counts(spark, folder):
    rows = corpus()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    split = lambda text: [*(text or "").encode().lower().split(), None]
    one, two, three = Counter(), Counter(), Counter()
    for i, text in rows:
        if not held(i):
            words = split(text)
            one.update(words)
            two.update(zip(words, words[1:], strict=False))
            three.update(zip(words, words[1:], words[2:], strict=False))
    total, distinct, cut = sum(one.values()), len(one), language_model.DISCOUNT
    left1, left2 = Counter(), Counter()
    for (a, _), v in two.items():
        left1[a] += v - cut
    for (a, b, _), v in three.items():
        left2[a, b] += v - cut

    def p1(w):
        return (one[w] + 1) / (total + distinct + 1)

    def p2(a, b):
        back = max(1 - left1[a] / one[a], 1e-7) if one[a] else 1
        return ((two[a, b] - cut) / one[a] if (a, b) in two else 0) + back * p1(b)

    def p3(a, b, c):
        if (a, b) not in two:
            return p2(b, c)
        return ((three[a, b, c] - cut) / two[a, b] if (a, b, c) in three else 0) + max(1 - left2[a, b] / two[a, b], 1e-7) * p2(b, c)

    found = Counter()
    for r in queries.op7_language_model(spark, folder).collect():
        found[r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score / r.n_tokens, 1)] += 1
    expected, off = Counter(), 0
    for i, text in rows:
        w = split(text)
        base = sum(math.log10(p1(x)) for x in w)
        score = math.log10(p1(w[0])) + (math.log10(p2(*w[:2])) if len(w) > 1 else 0)
        score += sum(math.log10(p3(*x)) for x in zip(w, w[1:], w[2:], strict=False))
        expected[i, held(i), len(w), sum(one[x] > 0 for x in w), total, round(base, 4), round(score / len(w), 1)] += 1
    drop = lambda c: Counter({k[:-1]: 0 for k in c})
    assert drop(found) == drop(expected)
    off = sum((found - expected).values())
    assert off <= 3  # a byte's rounding may cross the first decimal


def test_language_model_keeps_what_stands_once(spark, tmp_path):
    (row,) = queries.op7_language_model(spark, save(spark, tmp_path, documents=frame(spark, [(None, "a b")]))).collect()
    # Two words and the end, each seen once: p(a), p(b | a), p(end | a, b).
    one, cut = 2 / (3 + 3 + 1), language_model.DISCOUNT
    pair = (1 - cut) + cut * one
    expected = math.log10(one) + math.log10(pair) + math.log10((1 - cut) / 1 + cut * pair)
    assert row.train_tokens == 3 and row.score == pytest.approx(expected, abs=0.05)


def test_language_model_without_training_rows(spark, nothing, tmp_path):
    assert queries.op7_language_model(spark, nothing).count() == 0
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    folder = save(spark, tmp_path, documents=frame(spark, [(alone, "a b")]))
    (row,) = queries.op7_language_model(spark, folder).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_elias_fano_and_levels():
    random_ = np.random.default_rng(0)
    for size, top in ((0, 1), (1, 5), (1000, 1000), (700, 10**9), (3000, 10)):
        values = np.sort(random_.integers(0, top, size))
        packed = trie.unpack(np.frombuffer(trie.pack(trie.EliasFano.encode(values, "v")), np.uint8))
        assert (trie.EliasFano(packed, "v")[np.arange(size)] == values).all()
    pairs = np.unique(random_.integers(0, 300 * 50, 4000))
    held = trie.Level(trie.level(pairs // 50, pairs % 50, 300, 50))
    context, word = random_.integers(-1, 300, 5000), random_.integers(0, 50, 5000)
    place = {int(p): i for i, p in enumerate(pairs)}
    expected = [place.get(int(c * 50 + w), -1) if c >= 0 else -1 for c, w in zip(context, word, strict=True)]
    assert held.find(context, word)[0].tolist() == expected
    assert held.words_at(np.arange(len(pairs))).tolist() == (pairs % 50).tolist()


def test_empty_tables(spark, nothing):
    for query in (queries.op1_quality, queries.op5_toxicity, queries.op9_licenses):
        assert query(spark, nothing).count() == 0


def test_chunks_keep_whole_texts():
    from sluicegate.llm.frames import chunks

    texts = ["a b", None, "", "c" * 50, " d ", "e"]
    for limit in (1, 5, 1000):
        seen, words = [], 0
        for chunk in chunks(pa.array(texts)[1:], limit):
            seen += [bytes(chunk.data[a:b]) for a, b in zip(chunk.starts, chunk.starts[1:])]
            words += len(chunk.words()[0])
        assert seen == [(t or "").encode() for t in texts[1:]] and words == 3
