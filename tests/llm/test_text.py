"""Rules, formatting, decontamination and url filters against brute force."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quantloom.llm import chat_formatting, decontamination, quality_rules, url_filters
from quantloom.llm.common import work_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# ---- quality rules

def brute_measures(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    letters, stops = sum(any(c.isalpha() for c in x) for x in w), sum(lower(x) in quality_rules.STOP_WORDS for x in w)
    blanks = " \t\n\x0b\x0c\r"
    bullets = sum(x.lstrip(" \t")[:1] in tuple("-*•") for x in lines)
    ellipses, ends = sum(x.rstrip(blanks).endswith(("...", "…")) for x in lines), sum(x.rstrip(blanks).endswith(tuple('.!?"”»')) for x in lines)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), len(lines), letters, stops, bullets, ellipses, ends


def brute_keeps(text):
    n, chars, symbols, dup, again, lines, letters, stops, bullets, ellipses, ends = brute_measures(text)
    bad = n < 50 or 100 * again > 50 * n or 5 * symbols > n or (10 * dup > 5 * lines and dup >= 3) or chars < 2 * n or chars > 20 * n
    bad = bad or 10 * letters < 7 * n or stops < 2 or 10 * bullets > 9 * lines
    return not (bad or (10 * ellipses > 3 * lines and ellipses >= 3) or (10 * ends < lines and lines >= 5))


def test_measures_match_brute_force(docs, rows):
    more = [(900, "- a\n* b\n\t• c\n-d"), (901, "so...\nand…  \nend."), (902, "1 2 3 the THE Und"), (903, 'He said "x"\n«y»\nno end\r')]
    frame = docs.select("doc_id", "text", "h").unionByName(docs.sparkSession.createDataFrame([(i, t, "h") for i, t in more], "doc_id long, text string, h string"))
    got = quality_rules.ledger(frame).select("doc_id", *quality_rules.MEASURES).collect()
    assert Counter(map(tuple, got)) == Counter((i, *brute_measures(t)) for i, t in [*rows, *more])


def test_the_ledger_is_stored_once_for_all_policies(spark, docs, rows):
    path = work_path(spark, "ledger")
    book = quality_rules.write_ledger(docs, path)
    assert spark.read.parquet(path).columns == ["doc_id", *quality_rules.MEASURES, "failed_bits"] == book.columns
    assert all("documents" not in f for f in book.inputFiles()) and len(book.inputFiles()) > 0
    kept = quality_rules.apply_policy(book, quality_rules.POLICIES["v3"])
    assert Counter((r.doc_id, r.kept) for r in kept.collect()) == Counter((i, brute_keeps(t)) for i, t in rows)


def test_policies_are_masks_over_the_ledger(docs, rows, no_docs):
    book = quality_rules.ledger(docs)
    few, repeated = quality_rules.mask(["few_words"]), quality_rules.mask(["repeated_words"])
    bits = Counter((r.doc_id, r.failed_bits & few > 0, r.failed_bits & repeated > 0) for r in book.collect())
    want = Counter()
    for i, t in rows:
        n, _, _, _, again, *_ = brute_measures(t)
        want[i, n < 50, 100 * again > 50 * n] += 1
    assert bits == want
    kept = quality_rules.keep_quality(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in quality_rules.apply_policy(book, quality_rules.POLICIES["v3"]).filter("kept").collect())
    assert Counter(r.doc_id for r in kept.collect()) == ids
    assert quality_rules.keep_quality(no_docs).count() == 0 and quality_rules.ledger(no_docs).count() == 0


def test_stop_words_are_asked_of_languages_that_have_a_list_only(spark):
    text = " ".join(f"palavra{k}" for k in range(60)) + "."
    frame = spark.createDataFrame([(0, text, "en"), (1, text, "pt"), (2, text, None), (3, None, "pt")], "doc_id long, text string, lang string")
    book = {r.doc_id: (r.n_stop_words, r.failed_bits) for r in quality_rules.ledger(frame, lang_col="lang").collect()}
    stop, few = quality_rules.mask(["few_stop_words"]), quality_rules.mask(["few_words"])
    assert book[0] == (0, stop) and book[1] == book[2] == (None, 0) and book[3][0] is None and book[3][1] & (stop | few) == few
    assert sorted(r.doc_id for r in quality_rules.keep_quality(frame, lang_col="lang").collect()) == [1, 2]
    assert quality_rules.keep_quality(frame).count() == 0


def test_ablations_count_what_each_rule_costs(docs):
    book = quality_rules.ledger(docs)
    got = {(r.policy, r.without): r.n_kept for r in quality_rules.ablations(book).collect()}
    for (version, without), n in got.items():
        names = [x for x in quality_rules.POLICIES[version] if x != without]
        assert n == quality_rules.apply_policy(book, names).filter("kept").count()
    assert set(got) == {(v, w) for v, names in quality_rules.POLICIES.items() for w in (None, *names)}


def test_junk_goes_and_prose_stays(spark):
    prose = "the start of it " + " ".join(f"word{i}" for i in range(80))
    texts = [prose, " ".join(f"word{i}###" for i in range(80)), " | ".join(f"w{i}" for i in range(80)), "one line again\n" * 40, "a " * 60, " ".join(f"word{i}" for i in range(80)), "the of " + "".join(f"{i} " for i in range(99)), "".join(f"- the of {i}a b{i} c{i} d{i} e{i}\n" for i in range(20)), "".join(f"the of {i}a b{i} c{i} d{i} e{i} ...\n" for i in range(20)), "".join(f"the of {i}a b{i} c{i} d{i} e{i}\n" for i in range(20))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.doc_id for r in quality_rules.keep_quality(df).collect()] == [0]


# ---- chats

CHATS = [
    (1, 0, "user", "plain"), (1, 1, "assistant", "an answer"),
    (2, 1, "assistant", "</s>"), (2, 0, "user", "<s>user\nno turn</s>"), (2, 2, "assistant", "50% <e> [INST] %3C"),
    (3, 0, None, None), (3, None, "assistant", ""), (3, 0, "role\nwith break", "x"), (3, 5, "a</s>b", "c\nd\n"),
    (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (4, 0, "assistant", "%25 and <"),
    (None, 0, "assistant", "no conversation"), (5, 0, "user", "<" * 300 + "</s" + "%3C"), (5, 1, "assistant", "日本 </s> é"),
]


def test_chats_come_back_identical(spark):
    df = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash")).repartition(3)
    back = {r.conv_id: r for r in chat_formatting.read_chats(chat_formatting.format_chats(df)).collect()}
    want = {}
    for c, t, role, text in CHATS:
        want.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(back) == set(want)
    for c, turns in want.items():
        turns.sort()
        assert [(t["role"], t["text"]) for t in back[c].turns] == [x[1:] for x in turns]
        assert back[c].loss_texts == [x[2] for x in turns if x[1] == "assistant"]
        assert back[c].formatted.count("</s>") == len(turns) and back[c].identical
    assert "[INST]" not in back[2].formatted


def test_plain_turns_stay_plain(spark):
    df = spark.createDataFrame([(1, 0, "user", "100% <b>"), (1, 1, "assistant", "fine")], "conv_id long, turn long, role string, text string")
    (row,) = chat_formatting.format_chats(df).collect()
    assert row.formatted == "<s>user\n100% <b></s><s>assistant\nfine</s>"
    assert chat_formatting.format_chats(df.limit(0)).count() == 0


# ---- decontamination

ITEMS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "short item, three words"), (3, None), (4, "..."),
    (10, "ALPHA-beta gamma delta epsilon zeta eta theta iota kappa"), (2, "über straße"), (7, "solo"),
]


def brute_hits(text):
    w = NORMAL.findall(lower(text))
    windows = {}
    for i, t in ITEMS:
        x = NORMAL.findall(lower(t))
        n = min(10, len(x))
        for a in range(len(x) - n + 1 if x else 0):
            windows.setdefault(tuple(x[a : a + n]), set()).add(i)
    hit, items = set(), set()
    for win, ids in windows.items():
        for a in range(len(w) - len(win) + 1):
            if tuple(w[a : a + len(win)]) == win:
                hit.update(range(a, a + len(win)))
                items |= ids
    return len(w), hit, items


@pytest.mark.parametrize("role", ["user", "a\nb", "%0A", "<e>", ""])
@pytest.mark.parametrize("text", ["", "</s>", "%3C/s>", "<s>user\nx</s>", "[INST]%5B", "%25%", "<", "%", "\n", "a</s><e>b"])
def test_the_escaped_form_always_comes_back(spark, role, text):
    row = spark.range(1).select(chat_formatting.parse(chat_formatting.render_turn(F.lit(role), F.lit(text), True)).alias("t")).first()
    assert [(t["role"], t["text"]) for t in row.t] == [(role, text)]


@pytest.fixture(scope="module")
def leaky(spark, rows):
    more = [
        (100, "say alpha Beta, gamma delta epsilon zeta eta theta iota kappa; lambda mu"), (101, "alpha beta gamma delta epsilon zeta eta theta iota"), (102, "short item three words short item three words"),
        (103, "SOLO"), (104, "soloist"), (105, "Über straße; überstraße"), (105, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda alpha beta"),
    ]
    data = [(i, t, "w", "h") for i, t in [*rows, *more]]
    return spark.createDataFrame(data, "doc_id long, text string, words string, hits string").repartition(4)


def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_hits_match_brute_force(spark, leaky):
    got = decontamination.contaminated_words(leaky, bench(spark)).select(
        "__id", F.col("__text"), F.size("words").alias("n"), decontamination.covered(F.col("hits")).alias("hit"), F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))).alias("items")
    )
    want = Counter()
    for r in leaky.collect():
        n, hit, items = brute_hits(r.text)
        want[r.doc_id, r.text, n, len(hit), tuple(sorted(items))] += 1
    assert Counter((r[0], r[1], r.n, r.hit, tuple(sorted(r["items"]))) for r in got.collect()) == want


def test_clean_documents_stay_and_leaks_go(spark, leaky):
    clean = decontamination.decontaminate(leaky, bench(spark))
    assert clean.columns == leaky.columns
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter((r.doc_id, r.text) for r in leaky.collect() if not brute_hits(r.text)[1])
    nothing = bench(spark).limit(0)
    assert decontamination.decontaminate(leaky, nothing).count() == leaky.count()
    assert decontamination.decontaminate(leaky.limit(0), bench(spark)).count() == 0


def test_spans_are_cut_out(spark, leaky):
    got = Counter((r.doc_id, r.text) for r in decontamination.remove_spans(leaky, bench(spark)).collect())
    want = Counter()
    for r in leaky.collect():
        _, hit, _ = brute_hits(r.text)
        want[r.doc_id, " ".join(x for i, x in enumerate(NORMAL.findall(lower(r.text))) if i not in hit) if hit else r.text] += 1
    assert got == want


def test_large_benchmarks_are_probed_in_slices(spark, leaky, monkeypatch):
    before = Counter(map(tuple, decontamination.decontaminate(leaky, bench(spark)).collect()))
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 2)
    monkeypatch.setattr(decontamination, "BROADCAST_HITS", 0)
    assert Counter(map(tuple, decontamination.decontaminate(leaky, bench(spark)).collect())) == before


def test_windows_of_long_words_are_probed_in_slices(spark, leaky, monkeypatch):
    before = Counter(map(tuple, decontamination.decontaminate(leaky, bench(spark)).collect()))
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 500)
    assert Counter(map(tuple, decontamination.decontaminate(leaky, bench(spark)).collect())) == before


# ---- url filters

URLS = [
    None, "", "no scheme.org/x", "http://a.org", "http://a.org/", "HTTPS://Sub.Example.ORG/es/page", "http://example.org/en/12?x=/es/", "http://example.org/en/2",
    "http://notexample.org/es/", "x://example.com/fr/a", "x://example.com/de", "x://example.com/de/#f", "http://spam-farm.net/x", "http://my.spam.farm.example.net/", "http://spamfarm.net/",
    "http://host?q=://x.org/", "a://b://c.org/d", "http://EXAMPLE.com/FR/x", "http://x.org/spam-farm/", "ftp://müller.org/ü", "http://link-farm.de/", "http://x.net/Free_Casino",
    "http://m.casino-win.example.net/a", "http://free-bets.example.net", "http://cheappills.example.net", "http://pills.cheap.example.net/", "http://a.net/adult/x", "http://casino.example.net/", "http://ads-track.net",
]


def brute_url(url):
    at = (url or "").find("://")
    host = path = ""
    if at >= 0:
        m = re.match(r"([^/?#]*)([^?#]*)", url[at + 3 :])
        host, path = lower(m[1]), m[2]
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    t = re.split(r"[^a-z0-9]+", lower(host + path))
    junk = any(((a in x.split() and b in y.split()) or (b in x.split() and a in y.split())) for a, b in zip(t, t[1:]) for x, y in url_filters.JUNK)
    return host, path, None, "block" if junk else "allow"


@pytest.fixture(scope="module")
def pages(spark):
    data = [(i, u, "rule", "host") for i, u in enumerate(URLS)] + [(3, URLS[3], "rule", "host"), (None, URLS[5], "r", "h")]
    return spark.createDataFrame(data, "page_id long, url string, rule string, token string")


def test_urls_match_brute_force(pages):
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filters.filter_urls(pages).collect())
    assert got == Counter((r.page_id, *brute_url(r.url)) for r in pages.collect())
    assert url_filters.filter_urls(pages.limit(0)).count() == 0


def test_rules_are_indexed_by_their_rarest_token(spark, pages):
    rules = spark.createDataFrame([(1, ["org", "example"]), (2, []), (3, ["absent", "org"])], "priority long, tokens array<string>")
    urls = spark.createDataFrame([(["org"],), (["org", "example"],), (["org"],)], "__tokens array<string>")
    assert {r.priority: r.token for r in url_filters.index_rules(urls, rules).collect()} == {1: "example", 2: None, 3: "absent"}


def test_rules_without_tokens_and_equal_lengths_still_apply(pages):
    rules = [url_filters.Rule("any", r"^$", "block", 5), url_filters.Rule("b", r"/fr/", "block", 5), url_filters.Rule("a", r"/fr/a", "allow", 5)]
    got = {r.page_id: (r.rule, r.verdict) for r in url_filters.filter_urls(pages, rules, default="keep").collect()}
    assert got[0] == ("any", "block") and got[9] == ("b", "block") and got[7] == (None, "keep")


def test_tokens_are_read_off_the_pattern():
    u = url_filters
    assert len(u.JUNK_RULES) > 300 and all(len(r.tokens) == 2 for r in u.JUNK_RULES)
    assert [r.tokens for r in u.HOST_RULES] == [("org",), ("example", "org", "es"), ("example", "org", "en"), ("com", "fr"), ("com", "de")]
    for pattern, tokens in [("^a|b$", ()), ("/news/[0-9]+/x", ("news",)), (r"(?i)/Ad/s?ense/", ("ad",)), (r"\.php/", ("php",)), ("abc", ()), (r"/a\db/c/", ("c",)), ("/ab*/cd{2}/", ()), ("/x(yz)?/w/", ("w",))]:
        assert u.literal_tokens(pattern) == tokens, pattern


def test_junk_hosts_are_blocked_and_clean_ones_are_not(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = url_filters.filter_urls(pages, url_filters.JUNK_RULES).collect()
    junk = re.compile(r"casino-win|free-bets|cheap-pills|adult-x|spam-farm|ads-track")
    assert {bool(junk.search(r.host)) for r in got if r.verdict == "block"} == {True} and all(r.verdict == "block" for r in got if junk.search(r.host))
