"""The operators that look at rows one by one, and the conversations."""

import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lacuna.llm import chat, decontam, html_template, langid, packing, quality, token_store, url_filter
from lacuna.llm.tokens import CachedEncoder
from lacuna.scratch import new_folder

# Names the operators use inside, as columns of the input.
CLASHING = "host string, path string, rule string, kept boolean, t string, i int, h int, part int, n_words int, document int"


def documents(spark, rows):
    """Documents with columns of clashing names."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    extra = [F.lit(None).cast(kind).alias(name) for name, kind in (x.split() for x in CLASHING.split(", "))]
    return frame.select("*", *extra)


# --- URL filter


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
URLS = [
    ("http://A.Example.NET/en/x?q", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://a.example.net/english", "a.example.net", "/english", "net/", "block"),
    ("http://a.net", "a.net", "", None, "allow"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
    ("http://example.com/de/#x", "example.com", "/de/", "example.com/de/", "block"),
    ("http://x.org/fr/?a=://b", "x.org", "/fr/", "org/fr/", "allow"),
    ("no scheme/en/", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def judged(frame):
    return [tuple(r) for r in frame.collect()]


@pytest.mark.parametrize("way", ["list", "frame", "join"])
def test_url_rules(spark, way):
    rules = RULES
    if way != "list":
        rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    pages = spark.createDataFrame([(k, u[0]) for k, u in enumerate(URLS)] * 2, "page_id long, url string")
    pages = pages.withColumn("host", F.lit(1)).withColumn("rule", F.lit(2))
    out = url_filter.judge_urls(pages, rules, keep=("page_id",), broadcast_chars=0 if way == "join" else 1000)
    assert sorted(judged(out), key=str) == sorted([(k, *u[1:]) for k, u in enumerate(URLS)] * 2, key=str)


def test_block_wins_and_longest_path_decides():
    trie = url_filter.Trie([("allow", "a.b", "/x"), ("block", "a.b", "/x"), ("allow", "a.b", "/x/y"), ("block", "b", "/x/y/z")])
    assert trie.find("a.b", "/xx") == ("block", "a.b/x")
    assert trie.find("c.a.b", "/x/yz") == ("allow", "a.b/x/y")
    assert trie.find("b", "/x/y/zz") == ("block", "b/x/y/z")
    assert trie.find("b", "/x") is None


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from(["allow", "block"]), st.sampled_from(["a", "b.a", "c.b.a"]), st.text("/xy", max_size=5)), max_size=6),
    st.sampled_from(["a", "b.a", "c.b.a", "d", "ba"]),
    st.text("/xy", max_size=6),
)
def test_trie_is_the_longest_rule(rules, host, path):
    fits = [r for r in rules if ("." + host).endswith("." + r[1]) and path.startswith(r[2])]
    want = max(fits, key=lambda r: (r[1].count("."), len(r[2]), r[0] == "block"), default=None)
    found = url_filter.Trie(rules).find(host, path)
    assert found == (want and (want[0], want[1] + want[2]))


def test_url_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judged(url_filter.judge_urls(pages, RULES, keep=("page_id",))) == []


# --- quality rules


def brute_figures(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_figures(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a", "a b", "a b c", "x y z x y z", "a a a a a", "# $ <b>\x0b\x0cé ü 漢字   z", "l\nl\n \nl\r\nl"]
    texts += [" ".join(rng.choice("ab cd e\nf\n".split(" ")) for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += ["word " * 30_000]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "a b c a b c"), (3, "a")]
    found = quality.quality(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted((str(r.doc_id), *[r[n] for n in names]) for r in found)
    short = [(i, t) for i, t in rows if t is None or len(t) < 100_000]
    want = [(str(i), *brute_figures(t)) for i, t in short] + [(str(len(texts) - 1), 30_000, 120_000, 0, 0, 30_000)]
    assert got == sorted(want)


def test_quality_verdicts(spark):
    good = " ".join(f"the w{k} of" for k in range(40))
    rows = [(1, good), (2, "short"), (3, good.replace(" of", "*** of")), (4, "the same words " * 40), (5, None)]
    frame = documents(spark, rows)
    found = {r.doc_id: (r.base_failed, r.kept, r.failed_rules) for r in quality.quality(frame).collect()}
    assert found[1] == (False, True, [])
    assert found[2][:2] == (True, False) and found[4][:2] == (True, False) and found[5][:2] == (True, False)
    assert found[3] == (False, False, ["symbol_ratio"])
    kept = quality.kept_documents(frame)
    assert kept.columns == frame.columns and [r.doc_id for r in kept.collect()] == [1]


# --- chat


def test_chat_keeps_maximal_conversations(spark):
    def conv(i, *turns):
        return [(i, k, ("user", "bot")[k % 2], t) for k, t in enumerate(turns)]

    rows = conv(1, "a", "b") + conv(2, "a", "b", "c") + conv(3, "a", "x") + conv(4, "a", "b", "c")
    rows += conv(5, "a") + conv(6, None) + conv(7, "") + conv(8, None, "") + conv(None, "q", "r") + conv(9, "q")
    rows += [(10, 0, None, "a"), (10, 0, None, "a"), (11, 0, None, "a"), (12, 5, None, "later"), (12, 9, "user", "on")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumn("at", F.lit(1)).withColumn("p1", F.lit(1)).withColumn("turns", F.lit(1))
    out = {r.conv_id: r for r in chat.chat_format(frame).collect()}
    assert set(out) == {2, 3, 7, 8, None, 10, 12}
    assert out[2].text == "<|user|>\na\n<|end|>\n<|bot|>\nb\n<|end|>\n<|user|>\nc\n<|end|>\n"
    assert out[10].n_turns == 2 and out[12].text.startswith("<|unknown|>\nlater")
    parts = chat.chat_format(frame, segment_turns=1).filter("conv_id = 2").orderBy("segment").collect()
    assert [p.segment for p in parts] == [0, 1, 2] and "".join(p.text for p in parts) == out[2].text
    assert chat.chat_format(frame.limit(0)).count() == 0


# --- HTML


def test_parse_reads_broken_markup():
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<nav><ul><li><a href='/a'>Menu</a></ul></nav><!-- x > y --><div class=\"ad top\">Buy</div>"
        "<article><h1>Head &amp; tail</h1><p><b>one <i>two</i><br>three<p>four\n five&nbsp;&lt;x&gt;<ul><li>a<li>b</ul>"
        "<div id=comments><p>spam</div><form>f</form>5 < 6</article><footer>&copy;</footer>"
    )
    assert html_template.main_text(page) == "Head & tail\n\none two three\n\nfour five <x>\n\na\n\nb\n\n5 < 6"


def test_template_marks_slots(spark):
    def page(k):
        return f"<html><body><div><div>Site name</div><div><p>Story {k} begins</p><p>and ends {k * k}</p></div><div>All rights</div></div>"

    rows = [(k, "http://h.example/p", page(k)) for k in range(6)]
    rows += [(10, None, None), (11, "x", ""), (12, None, "<p>alone"), (12, None, "<p>alone")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(0)).withColumn("tokens", F.lit(0))
    for most in (1 << 20, 0):
        out = sorted((r.page_id, r.text, r.n_chars) for r in html_template.extract(frame, broadcast_tokens=most).collect())
        assert out[3][:2] == (3, "Story 3 begins\n\nand ends 9")
        assert out[6:] == [(10, "", 0), (11, "", 0), (12, "alone", 5), (12, "alone", 5)]
    assert html_template.extract(frame.limit(0)).count() == 0


def texts_of(spark, pages, url="http://h.example/p"):
    rows = [(k, url, p) for k, p in enumerate(pages)]
    out = html_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(out, key=lambda r: r.page_id)]


def test_a_sentence_that_few_pages_share_stays(spark):
    shared = "A sentence that two articles of a small host have in common, word for word."

    def page(k, n):
        return f"<body><main><article><p>Story {k} begins.</p>{f'<p>{shared}</p>' if k < n else ''}<p>It ends {k * k}.</p></article></main>"

    for n in (2, 3):
        texts = texts_of(spark, [page(k, n) for k in range(4)])
        assert [shared in t for t in texts] == [k < n for k in range(4)]


def test_a_notice_without_a_class_on_all_pages_goes(spark):
    notice = "<p>All our articles may be read by all who like to read.</p>"

    def page(k):
        return f"<body><article><p>Story {k} begins.</p>{notice}<p>It ends {k * k}.</p></article>"

    for url in ("http://h.example/p", "http://*/p"):  # the second host was the name of all pages
        assert texts_of(spark, [page(k) for k in range(4)], url) == [f"Story {k} begins.\n\nIt ends {k * k}." for k in range(4)]


def test_near_copies_are_no_template(spark):
    story = [f"Paragraph {k} of a story that is told again and again." for k in range(5)]
    stories = [[*story[:2], f"What only copy {k} says.", *story[2:]] for k in range(6)]
    stories += [[f"Story {k} is another one, part {j}." for j in range(4)] for k in range(4)]
    pages = [f"<body><div><div>Site name</div><div>{''.join(f'<p>{p}</p>' for p in s)}</div><div>All rights</div></div>" for s in stories]
    assert texts_of(spark, pages) == ["\n\n".join(s) for s in stories]


def test_classes_are_ordered_and_nest(spark):
    def page(k):
        ends = ["<div>Stays first</div>", "<div>Or second</div>"][:: 1 if k % 2 else -1]
        some = "<div>Now and then</div>"  # in one slot of the root class or in another
        first, last = (some, "") if k % 3 else ("", some)
        return f"<body><div>Top</div>{first}<section><p>Story {k} of many, of some length</p></section>{last}<div>End</div>{''.join(ends)}"

    for k, text in enumerate(texts_of(spark, [page(k) for k in range(12)])):
        assert "Top" not in text and "End" not in text
        assert "Now and then" in text and f"Story {k} of many" in text
        assert "Stays first" in text or "Or second" in text


def test_template_inside_marked_articles(spark):
    notice = "<div class=box>Please read our house rules before you write.</div>"
    pages = [f"<body><article><h1>Story {k}</h1><p>Begins {k}.</p>{notice}<p>Goes on {k * k}.</p></article>" for k in range(8)]
    pages.append("<body><article><h1>Other</h1><p>Without a word.</p></article>")
    want = [f"Story {k}\n\nBegins {k}.\n\nGoes on {k * k}." for k in range(8)] + ["Other\n\nWithout a word."]
    assert texts_of(spark, pages) == want
    assert texts_of(spark, pages[:8]) == want[:8]


@pytest.mark.parametrize(
    "wrapper",
    [
        '<div class="no-sidebar"><article>{}</article></div>',
        '<div id="page" class="has-sidebar">{}</div>',
        '<main class="with-sidebar">{}</main>',
        '<article class="post comments-open">{}</article>',
        '<div class="page sidebar"><div><main>{}</main></div><p>Beside</p></div>',
        '<form id=f><div class="social">{}</div></form>',
        '<form><article class="post sponsored">{}</article></form>',
    ],
)
def test_words_of_wrappers_drop_no_article(wrapper):
    inside = '<p>One</p><div class="share-price"><p>Two</p></div><div class=related-work>Three</div>'
    page = f"<body>{wrapper.format(inside)}<footer>Foot</footer>"
    assert html_template.main_text(page) == "One\n\nTwo\n\nThree"


def test_asides_of_articles_stay_out():
    page = "<main><p>Text</p><div class='box related'><article>Another</article></div><aside><article>Third</article></aside></main>"
    assert html_template.main_text(page) == "Text"
    assert html_template.main_text("<form>Sign up</form><p>Text") == "Text"


def test_long_and_odd_pages_end():
    assert html_template.main_text("<a " * 50_000) == ""
    assert html_template.main_text("<p>x" * 20_000).count("x") == 20_000
    assert html_template.main_text("<div>" * 20_000 + "y") == "y"
    assert html_template.main_text("<script>" + "z" * 1000) == ""


# --- language


def test_codewords_are_apart():
    for n in range(1, 12):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code}) == n


def test_language(spark):
    rng = random.Random(1)
    words = {"aa": "kala mala tala".split(), "bb": "xerxes quoz zyx".split(), "cc": "über öfen äsche".split()}
    rows = [(k, " ".join(rng.choices(words[lang], k=30)), lang) for k in range(300) for lang in [sorted(words)[k % 3]]]
    rows += [(900, None, "aa"), (901, "123 ... !!", "bb"), (902, "", None), (None, "kala mala", "aa"), (903, "kala " * 40_000, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("t", F.lit(1)).withColumn("score", F.lit(0))
    model = langid.train(frame)
    out = langid.identify(frame, model).collect()
    assert len(out) == len(rows)
    of = {r.doc_id: r for r in out}
    assert [of[k].lang_pred for k in (900, 901, 902, None, 903)] == ["und", "und", "und", "aa", "aa"]
    assert all(of[k].lang_pred == lang for k, _, lang in rows[:300] if of[k].held_out)
    assert all(0 <= r.score <= 1 for r in out) and not of[None].held_out
    none = langid.identify(frame, langid.train(frame.filter("lang IS NULL"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert langid.identify(frame.limit(0), model).count() == 0


# --- tokens


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(" \n\t\r\x1c ́aBzéÉßİΣ漢12'*.<|>$"), max_size=40))
def test_cached_ids_are_the_tokenizers(text):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        known = ENCODERS.setdefault(name, CachedEncoder(public_tokenizers.path(name), 50))
        assert known.ids(text).tolist() == known.tokenizer.encode(text, add_special_tokens=False).ids


ENCODERS: dict = {}


def test_long_texts_in_parts(monkeypatch):
    text = "Some words,  more\n words\n\n here  and there. " * 9
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        known = CachedEncoder(public_tokenizers.path(name))
        whole = known.ids(text).tolist()
        monkeypatch.setattr("lacuna.llm.tokens._PART", 20)
        assert known.ids(text).tolist() == whole == known.tokenizer.encode(text, add_special_tokens=False).ids
        monkeypatch.undo()
    rows = langid.grams([text, "x", text[:30]])
    monkeypatch.setattr(langid, "_PART", 7)
    assert np.array_equal(langid.grams([text, "x", text[:30]]), rows)
    index = decontam.Items([1, 2], ["a passage that is to be found in it", "found"])
    page = "b" * 95 + "a passage that is tobe found in it" + "c" * 300 + "a passage that is to be found in it"
    assert index.find([page, "", "found"], part=30) == index.find([page, "", "found"])
    assert {x[0] for x in index.find([page])[0]} == {1, 2}


def test_special_tokens_in_texts():
    known = CachedEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    text = "a<|endoftext|>b <|endoftext|> it's  they'll\n\n x"
    assert known.ids(text).tolist() == known.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["one two", "one  two", " one", "one ", "one\n two", "one \ntwo", "one.\n\ntwo x", "one a\u00a0b", "", " "])
def test_words_after_a_space_are_looked_up_without_it(text):
    known = CachedEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    for _ in range(2):
        assert known.ids(text).tolist() == known.tokenizer.encode(text, add_special_tokens=False).ids
    if text == "one two":
        assert set(known._spaced) == {"two"} and set(known._chunks) == {"one"}


def test_a_word_is_remembered_once():
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        known = CachedEncoder(public_tokenizers.path(name))
        for text in ("one two", "one, two, two."):
            assert known.ids(text).tolist() == known.tokenizer.encode(text, add_special_tokens=False).ids
        assert not {"one", "two", " one", " two"} & set(known._pieces)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | st.text(st.sampled_from("   \n\t\r\x1c\u00a0\u0301aBzéÉßİΣ漢\u02b0\u0120ª12'*.<|>$"), max_size=40), max_size=6))
def test_ids_of_many_texts_are_the_tokenizers(texts):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        known = ENCODERS.setdefault(name, CachedEncoder(public_tokenizers.path(name), 50))
        found = known.many(pa.array([None, *texts], pa.string()).slice(1))
        want = [known.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(x, known.dtype).tolist() for x in found] == want


def test_new_words_of_many_texts_go_to_the_model_together(monkeypatch):
    monkeypatch.setattr("lacuna.llm.tokens._TOGETHER", 7)
    monkeypatch.setattr("lacuna.llm.tokens._PART", 2000)
    known = CachedEncoder(public_tokenizers.path("byte_bpe_50k.json"), 60)
    names = ["".join(chr(97 + (k * j) % 26) for j in range(1, 9)) + "éß"[: k % 3] for k in range(1, 90)]
    texts = [" ".join(["a", *names[k : k + 30], names[k] + ").", "b\nc", "it's"]) for k in range(60)]
    texts += ["", None, " x", "<|endoftext|> a<|endoftext|>", "a  b", "long text " * 300]
    one_by_one = []
    monkeypatch.setattr(known, "_mapped", lambda piece, f=known._mapped: one_by_one.append(piece) or f(piece))
    for _ in range(2):
        found = known.many(pa.array(texts))
        assert [np.frombuffer(x, known.dtype).tolist() for x in found] == [
            known.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts
        ]
    assert not {x.lstrip("\u0120") for x in one_by_one} & set(names)
    assert len(known._spaced) <= 60


def test_token_store_round_trip(spark):
    rows = [(k * 7 % 50, f"Some text {k} of words, " * (k % 9)) for k in range(50)]
    rows += [(None, "no id"), (60, None), (61, "a"), (61, "b"), (61, "b"), (62, "long text " * 50_000)]
    folder = new_folder(spark, "store")
    token_store.write_tokens(documents(spark, rows), folder)
    known = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((str(i), known.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows)
    read = token_store.read_tokens(spark, folder).collect()
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in read) == want
    some = token_store.read_tokens(spark, folder, [60, 7]).collect()
    assert sorted(r.doc_id for r in some) == [7, 60]
    out = token_store.stored(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in out] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in out:
        assert r.start == at
        at += r.n_tokens
    empty = new_folder(spark, "store")
    token_store.write_tokens(documents(spark, []), empty)
    assert token_store.stored(spark, empty).count() == 0


# --- packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=30), st.sampled_from([16, 64, 128]))
def test_pack_holds_every_id_once(sizes, window):
    rng = np.random.default_rng(len(sizes))
    docs = [rng.integers(0, 50, n).astype(np.uint16) for n in sizes]
    idf = np.ones(50, np.float32)
    seen = [set() for _ in docs]
    for row in packing.pack(docs, idf, 100.0, window):
        length = sum(n for _, _, n in row)
        assert length == window or length & (length - 1) == 0
        for k, start, n in row:
            ids = set(range(start, start + n))
            assert n > 0 and not ids & seen[k]
            seen[k] |= ids
    assert all(s == set(range(len(d))) for s, d in zip(seen, docs, strict=True))


def test_neighbours_share_words():
    docs = [np.array([t] * 20 + [9]) for t in (1, 2, 3, 1, 2, 3)]
    idf = np.array([0, 1, 1, 1, 0, 0, 0, 0, 0, 0], np.float32)
    rows = [[k for k, _, _ in row] for row in packing.pack(docs, idf, 21, 42)]
    assert sorted(sorted(r) for r in rows) == [[0, 3], [1, 4], [2, 5]]


def test_frequent_terms_count():
    # A third of the documents is one group whose terms are all frequent.
    n, group = 90, 30
    frequency = np.zeros(200, np.int64)
    rng = np.random.default_rng(4)
    docs = [np.array([5] * 3 + [6] * 3 + [7]) if k % 3 == 0 else np.append(rng.integers(20, 200, 6), 10) for k in range(n)]
    for d in docs:
        frequency[np.unique(d)] += 1
    idf = packing.Corpus(n, 7.0, frequency).idf
    assert (idf[5:8] > 0).all()
    rows = [{k for k, _, _ in row} for row in packing.pack(docs, idf, 7.0, 14)]
    assert sum(all(k % 3 == 0 for k in row) for row in rows if any(k % 3 == 0 for k in row)) == group // 2


@pytest.mark.parametrize("dense", [0, 0.2, 1])
def test_neighbours_are_brute_force_bm25(monkeypatch, dense):
    monkeypatch.setattr(packing, "DENSE", dense)
    monkeypatch.setattr(packing, "HEAD", 5)
    rng = np.random.default_rng(7)
    docs = [(rng.zipf(1.4, rng.integers(1, 60)) % 80).astype(np.uint16) for _ in range(70)]
    frequency = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=80)
    mean = sum(map(len, docs)) / len(docs)
    idf = packing.Corpus(len(docs), mean, frequency).idf
    shard = packing.Shard(docs, idf, mean)
    unused = np.ones(len(docs), bool)
    for seed in range(len(docs)):
        unused[seed] = False
        want = {}
        for k in np.flatnonzero(unused).tolist():
            score = 0.0
            for term in np.unique(docs[seed]).tolist():
                tf = int((docs[k] == term).sum())
                score += float(idf[term]) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(docs[k]) / mean))
            if score:
                want[k] = score
        found = list(shard.neighbours(seed, unused))
        assert sorted(found) == sorted(want)
        assert np.allclose([want[k] for k in found], sorted(want.values(), reverse=True), atol=1e-3)


@pytest.mark.parametrize("most", [1, 40, 1 << 20])
def test_terms_of_documents(monkeypatch, most):
    monkeypatch.setattr(packing, "SORTED_IDS", most)
    draw = np.random.default_rng(5)
    for kind, top in ((np.uint16, 1 << 16), (np.uint32, 1 << 20), (np.int64, 9)):
        docs = [draw.integers(top - 9, top, n).astype(kind) for n in (0, 30, 0, 5, 41, 1, 0)]
        found = [tuple(x) for part in packing.terms_of(docs) for x in zip(*(y.tolist() for y in part), strict=True)]
        assert found == [(k, t, n) for k, d in enumerate(docs) for t, n in zip(*(x.tolist() for x in np.unique(d, return_counts=True)), strict=True)]
    assert list(packing.terms_of([])) == []


def test_columns_and_postings_are_thinned_together():
    draw = np.random.default_rng(11)
    docs = [np.append(draw.integers(10, 400, 30), draw.integers(0, 10, 20)) for _ in range(200)]
    idf = packing.Corpus(300, 50.0, np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=400)).idf
    shard, unused = packing.Shard(docs, idf, 50.0), np.ones(200, bool)
    assert shard.columns.shape[1]
    for used in np.array_split(draw.permutation(199) + 1, 9):
        found = list(shard.neighbours(0, unused))
        assert sorted(found) == sorted(packing.Shard(docs, idf, 50.0).neighbours(0, unused))
        assert unused[found].all() and len(shard.columns) == len(shard.alive) > shard.owner.max()
        assert np.count_nonzero(unused) >= packing.THIN * len(shard.alive)
        unused[used[:20]] = False


def test_pack_documents(spark):
    rows = [(k, f"word{k % 5} and more " * (k * 13 % 400)) for k in range(40)] + [(None, None), (1, "again"), (1, "again")]
    out = packing.pack_documents(documents(spark, rows)).collect()
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = sum(len(known.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r.length for r in out) == total
    assert packing.pack_documents(documents(spark, [])).count() == 0


def test_postings_of_used_documents_are_dropped():
    draw = np.random.default_rng(3)
    docs = [draw.integers(0, 400, 30) for _ in range(200)]
    idf = packing.Corpus(200, 30.0, np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=400)).idf
    shard, unused = packing.Shard(docs, idf, 30.0), np.ones(200, bool)
    before = len(shard.owner)
    for used in np.array_split(draw.permutation(199) + 1, 9):
        assert list(shard.neighbours(0, unused)) == list(packing.Shard(docs, idf, 30.0).neighbours(0, unused))
        assert np.count_nonzero(unused) >= packing.THIN * len(np.unique(shard.owner))
        unused[used[:20]] = False
    assert len(shard.owner) < before / 3


# --- decontamination


def edit_distance_inside(item, text):
    """Least edits between the item and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j - 1] + (a != b), last[j] + 1, row[j - 1] + 1))
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abc", max_size=20), st.integers(0, 4))
def test_alignment_is_the_edit_distance(item, text, most):
    found = decontam.align(item, text, -len(item) - 1, len(text) + 1, most)
    want = edit_distance_inside(item, text)
    assert (found and found[0]) == (want if want <= most else None)
    if found:
        assert edit_distance_inside(item, text[found[1] : found[2]]) == want


def test_lemma_loses_nothing():
    rng = random.Random(5)
    letters = "abcdefghij klmnop"
    items = ["".join(rng.choices(letters, k=n)).strip() for n in (5, 30, 90, 200, 300)]
    index = decontam.Items(list(range(len(items))), [decontam.normal(t) for t in items])
    for _ in range(60):
        k = rng.randrange(len(items))
        copy = list(index.texts[k])
        for _ in range(rng.randrange(int(index.budget[k]) + 3)):
            at = rng.randrange(len(copy))
            copy[at : at + rng.randrange(2)] = rng.choice(["", "z", "q"])
        text = decontam.normal("".join(rng.choices(letters, k=400)) + "".join(copy) + "".join(rng.choices(letters, k=300)))
        found = {h[0] for h in index.find(["other text", text, ""])[1]}
        want = {j for j, t in enumerate(index.texts) if edit_distance_inside(t, text) <= index.budget[j]}
        assert found == want


def test_contamination(spark):
    item = "A benchmark question with enough words to be told from others, is it not?"
    rows = [(1, "x " * 50 + item.upper().replace(" ", "\n") + " y"), (2, "clean text"), (3, None), (4, ""), (1, "clean")]
    rows += [(5, item.replace("question", "querstion")), (None, item), (6, "x" * 200_000 + item)]
    bench = spark.createDataFrame([(7, item), (8, None), (9, "  "), (None, "another item that is nowhere")], "item_id long, text string")
    frame = documents(spark, rows)
    out = decontam.contamination(frame, bench).collect()
    assert sorted((str(r.doc_id), r.contaminated, tuple(r.item_ids)) for r in out) == sorted(
        [("1", True, (7,)), ("2", False, ()), ("3", False, ()), ("4", False, ()), ("1", False, ()), ("5", True, (7,)), ("None", True, (7,)), ("6", True, (7,))]
    )
    clean = decontam.clean_documents(frame, bench)
    assert clean.columns == frame.columns and sorted(r.doc_id for r in clean.collect()) == [1, 2, 3, 4]
    assert decontam.contamination(frame, bench.limit(0)).filter("contaminated").count() == 0
    assert decontam.contamination(frame.limit(0), bench).count() == 0


def test_benchmark_in_blocks(spark):
    items = [(k, " ".join(f"w{k}x{j}" for j in range(12))) for k in range(9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks = list(decontam.item_blocks(bench, block_chars=100))
    assert len(blocks) > 2 and sorted(i for b in blocks for i, _ in b) == list(range(9))

