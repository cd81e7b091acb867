"""URL filters, ranked search and conversation repair against plain code, on awkward tables."""

import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import lexical, repair, urls

# ---- URL filters

URL_SCHEMA = "page_id long, url string, host int, rule int, pattern string, verdict string, _listed string"


def page(k, url):
    return (k, url, 1, 2, "own", "own", "own")


def plain_host(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def plain_rule(url):
    host, path = plain_host(url)
    fits = []
    for rule, verdict in urls.LISTED:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def plain_tokens(url):
    if not url or "://" not in url:
        return set()
    host, path = plain_host(url)
    rest = url.split("://", 1)[1]
    rest = rest[len(re.match("[^?#]*", rest)[0]):]
    out = set()
    for mark, text in (("h:", host), ("p:", path), ("q:", rest)):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        out |= {mark + w for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[0-9]+", "0", lower))}
    return out


def plain_rules(labelled, p):
    """All token combinations, counted one by one."""
    rows = [(plain_tokens(u), bad) for u, bad in labelled if u is not None]
    least = max(math.ceil(p.least_share * len(rows)), p.least_urls)
    n = {}
    for tokens, _ in rows:
        for t in tokens:
            n[t] = n.get(t, 0) + 1
    seen, right = {}, {}
    for tokens, bad in rows:
        items = sorted(sorted((t for t in tokens if n[t] >= least), key=lambda t: (n[t], t))[: p.most_items])
        for size in range(1, len(items) + 1):
            for some in itertools.combinations(items, size):
                seen[some] = seen.get(some, 0) + 1
                right[some] = right.get(some, 0) + bad
    rules = {s for s in seen if right[s] >= least and right[s] / seen[s] >= p.least_confidence}
    return {(s, right[s] / seen[s]) for s in rules if not any(set(r) < set(s) for r in rules)}


AWKWARD_URLS = [
    "http://Example.ORG/es/1?x#y", "https://a.example.org/en/17", "ftp://example.org/en/2", "http://example.org", "http://org/", "http://xorg/a",
    "http://shop.com/fr/", "http://shop.com/de/x", "http://shop.com?de/", "http://com/de/", "no scheme/de/", "", None, "://", "http://", "x://y://com/fr/",
    "http://com.example.org.evil.net/de/", "http://ünï.com/de/ß?Ä=1", "http://a.net/" + "seg1/" * 20_000, "http://a.net/p\nq?r\ns=1", "http://a.net/%20a%2F",
]


def test_listed_rules_and_parts(spark):
    rows = spark.createDataFrame([page(k, u) for k, u in enumerate([*AWKWARD_URLS, AWKWARD_URLS[0]])], URL_SCHEMA).repartition(3)
    got = {r.page_id: r for r in urls.judge(rows, urls.Index((), ())).withColumn("tokens", urls.tokens_of(F.col("url"))).collect()}
    assert len(got) == len(AWKWARD_URLS) + 1
    for k, u in enumerate([*AWKWARD_URLS, AWKWARD_URLS[0]]):
        rule, verdict = plain_rule(u)
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict, got[k].pattern) == (*plain_host(u), rule, verdict or "allow", None), u
        assert set(got[k].tokens) == plain_tokens(u) and len(got[k].tokens) == len(set(got[k].tokens)), u


def labelled_sample():
    rng = random.Random(3)
    out = []
    for k in range(600):
        host = rng.choice(["free-bets", "cheap-pills", "news", "blog", "wiki"]) + rng.choice([".example.net", ".other.net"])
        url = f"http://{host}/{rng.choice(['en', 'fr', 'win'])}/{k}?{rng.choice(['ref', 'page', 'utm'])}={k}"
        bad = ("free-bets" in url and "/win/" in url) or ("pills" in url and "ref" in url) or rng.random() < 0.05
        out.append((url, bad))
    return out + [(None, True), ("http://news.example.net/en/1", None), ("http://" + "w." * 30 + "net/", False)] + [("http://one.of.many.copies.example.net/a/b/c/d", False)] * 200


@pytest.mark.parametrize("p", [urls.Params(), urls.Params(least_share=0.02, most_items=4, least_confidence=0.8)])
def test_mined_rules_are_all_there_are(spark, p):
    rows = labelled_sample()
    df = spark.createDataFrame([(u, b, 5) for u, b in rows], "url string, bad boolean, row int").repartition(4)
    found = urls.mine(df, p)
    got = {(tuple(r.tokens), r.confidence) for r in found.collect()}
    want = plain_rules([(u, bool(b)) for u, b in rows], p)
    assert {t for t, _ in got} == {t for t, _ in want} and len(want) > 1
    assert {(t, round(c, 9)) for t, c in got} == {(t, round(c, 9)) for t, c in want}
    index = urls.inverted(found, p)
    asked = [*AWKWARD_URLS, *[u for u, _ in rows if u]]
    judged = urls.judge(spark.createDataFrame([page(k, u) for k, u in enumerate(asked)], URL_SCHEMA), index, p=p).collect()
    rules = [set(t) for t, _ in want]
    for r in judged:
        rule, verdict = plain_rule(asked[r.page_id])
        hit = rule is None and any(x <= plain_tokens(asked[r.page_id]) for x in rules)
        assert (r.verdict == (verdict or ("block" if hit else "allow"))) and (r.pattern is not None) == hit
    assert any(r.pattern for r in judged)


def test_rules_of_urls_with_many_frequent_tokens(spark):
    """The combination that tells bad pages lies beyond the rarest tokens, and long copies end."""
    rng, out = random.Random(5), []
    for k in range(400):
        left, right = rng.random() < 0.7, rng.random() < 0.7
        rare = "/".join(f"{c}{rng.choice('xyz')}" for c in "abcdefghij")  # ten tokens rarer than the two that tell
        out.append((f"http://s.net/{rare}/{'left' if left else 'l'}?{'right' if right else 'r'}={k}", left and right and rng.random() < 0.9))
    out += [("http://long.net/" + "/".join(f"w{chr(97 + j)}" for j in range(26)), k < 40) for k in range(100)]
    p = urls.Params(least_share=0.1, least_confidence=0.8)
    found = urls.mine(spark.createDataFrame(out, "url string, bad boolean").repartition(4), p).collect()
    rows = [(plain_tokens(u), bad) for u, bad in out]
    got = {tuple(r.tokens): (r.confidence, r.support) for r in found}
    assert ("p:left", "q:right") in got
    tokens = sorted(set().union(*(t for t, _ in rows)))
    some = [t for t in tokens if sum(bad for s, bad in rows if t in s) >= 50]
    rules = {}
    for size in (1, 2, 3):
        for c in itertools.combinations(some, size):
            seen = [bad for s, bad in rows if s.issuperset(c)]
            if sum(seen) >= 50 and sum(seen) / len(seen) >= 0.8 and not any(set(r) < set(c) for r in rules):
                rules[c] = (sum(seen) / len(seen), sum(seen) / len(rows))
    assert {t for t in got if len(t) <= 3} == set(rules)
    assert all(math.isclose(a, b) for t in rules for a, b in zip(got[t], rules[t], strict=True))


def test_no_labels_no_rules_and_empty_tables(spark):
    none = spark.createDataFrame([], "url string, bad boolean")
    assert urls.mine(none).count() == 0
    index = urls.inverted(urls.mine(none))
    assert urls.judge(spark.createDataFrame([], URL_SCHEMA), index).count() == 0
    pages = spark.createDataFrame([(1, "http://a.net/en/7.html"), (2, "http://a.net/en/8"), (3, None), (4, "http://a.net/en/99999999999999999999")], "page_id long, url string")
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, None), (8, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, urls.labelled_urls(pages, labels).collect())) == [("http://a.net/en/7.html", True), ("http://a.net/en/8", False)]


# ---- ranked search

DOC_SCHEMA = "doc_id long, text string, score double, rank int, item_id long, length int, terms string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k=10):
    held = [(i, plain_terms(t)) for i, t in docs]
    held = [(i, ws) for i, ws in held if ws]
    n_docs, total = len(held), sum(len(ws) for _, ws in held)
    df = {}
    for _, ws in held:
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        rows = []
        for i, ws in held:
            m = 25 + (75 * len(ws) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * ws.count(w)) // (1000 * ws.count(w) + 8 * m))
                        for w in plain_terms(text) if w in df)
            if score > 0:
                rows.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(rows, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def search_case():
    rng = random.Random(8)
    words = [f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(4000)] + ["ÄPFEL", "äpfel", "naïve", "日本", "X-ray", "x"]
    docs = [(k, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for k in range(700)]
    docs += [(k + 1000, docs[5][1]) for k in range(30)]  # ties
    docs += [(None, docs[5][1]), (3, docs[3][1]), (2000, None), (2001, ""), (2002, "... !"), (2003, " ".join(rng.choices(words, k=30_000)))]
    items = [(k, " ".join(rng.choices(words, k=rng.randint(1, 25)))) for k in range(12)]
    items += [(50, docs[5][1]), (51, "w1 w1 W1"), (52, ""), (53, None), (54, "absent unheard"), (55, "..."), (56, "ÄPFEL Äpfel 日本")]
    return docs, items


@pytest.mark.parametrize("p", [lexical.Params(), lexical.Params(shard_rows=100, leaf=4, block_bytes=400), lexical.Params(leaf=1, shard_rows=1 << 20)])
def test_ranked_search_equals_plain_scores(spark, p):
    docs, items = search_case()
    frame = spark.createDataFrame([(i, t, 0.5, 1, 9, 3, "own") for i, t in docs], DOC_SCHEMA).repartition(3)
    asked = spark.createDataFrame([*items, (None, "w1 w2")], "item_id long, text string")
    got = sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.ranked_search(frame, asked, p).collect())
    assert [(a, b, d) for a, b, _, d in got] == [(a, b, d) for a, b, _, d in sorted(plain_search(docs, items), key=lambda r: r[:2])]
    assert [r[2] for r in got] == [r[2] for r in sorted(plain_search(docs, items), key=lambda r: r[:2])]


def test_ranked_search_over_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOC_SCHEMA), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    full = spark.createDataFrame([(1, "a b", 0.5, 1, 9, 3, "own")], DOC_SCHEMA)
    assert [lexical.ranked_search(d, i).count() for d, i in ((docs, items), (docs, some), (full, items), (full, some))] == [0, 0, 0, 1]


def test_range_maxima_and_pruning():
    rng = random.Random(1)
    import numpy as np

    size, n_terms = 3000, 12
    postings = [(t, d) for t in range(n_terms) for d in sorted(rng.sample(range(size), rng.choice([1, 7, 900, 3000])))]
    term, owner = np.array([t for t, _ in postings]), np.array([d for _, d in postings])
    impact = np.array([rng.randint(1, 10_000) for _ in postings], np.int64)
    shard = lexical.Shard(np.arange(size) * 3, owner, term, impact)
    for _ in range(200):
        lo, hi = sorted(rng.sample(range(size + 1), 2))
        first, last = shard.ranges(np.arange(n_terms), lo, hi)
        some = last > first
        peak = shard.largest(first[some], last[some])
        for t, at in zip(np.arange(n_terms)[some], peak, strict=True):
            here = (term == t) & (owner >= lo) & (owner < hi)
            assert shard.impact[at] == impact[here].max()
    for leaf in (1, 64, 5000):
        asked = np.array(rng.sample(range(n_terms), 5))
        scores = np.zeros(size, np.int64)
        for t in asked:
            np.add.at(scores, owner[term == t], 2 * impact[term == t])
        top = lexical.search(shard, asked, np.full(5, 2), [], lexical.Params(leaf=leaf))
        assert sorted(top, reverse=True) == [(int(scores[d]), -3 * int(d)) for d in np.lexsort((np.arange(size), -scores))[:10]]


# ---- conversation repair

def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        how = zlib.crc32(key.encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        role = "user" if how == 4 else role
        out += [] if how == 0 else [(conv, turn, role, text)] * (2 if how == 3 else 1)
    return out


def plain_order(r):
    return (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest())


def plain_repair(rows):
    """Every edit script of at most two insertions in a row, tried out."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        faults.append(1 if not core else 2 if (role, text) in seen else 3 if core[-1] not in ".!?" else 0)
        seen.add((role, text))
    best = []

    def go(k, cost, audit, letters, lines):
        if k == len(rows):
            for more in range(3):
                for roles in itertools.product(("user", "assistant"), repeat=more):
                    if re.fullmatch("(s?(ua)+)?", letters + "".join(r[0] for r in roles)):
                        best.append((cost + 3 * more, audit + "I" * more, [*lines, *[f"{r}:" for r in roles]]))
            return
        _, _, role, text = rows[k]
        for more in range(3):
            for roles in itertools.product(("user", "assistant"), repeat=more):
                c, a = cost + 3 * more, audit + "I" * more
                seq, out = letters + "".join(r[0] for r in roles), [*lines, *[f"{r}:" for r in roles]]
                if not re.fullmatch("s?(ua)*u?", seq):
                    continue
                go(k + 1, c + 4, a + "D", seq, out)
                if faults[k] in (1, 2):
                    continue
                late = 3 if faults[k] == 3 else 0
                for letter, name, price in (("K", role, 0), ("R", "user", 3), ("R", "assistant", 3)):
                    if name[:1] and re.fullmatch("s?(ua)*u?", seq + name[0]):
                        go(k + 1, c + price + late, a + letter, seq + name[0], [*out, f"{name}:{text}"])

    go(0, 0, "", "", [])
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, lines = min(best)
    return (gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversation(rng, conv, n):
    roles, texts = ["user", "assistant", "assistant", "user", "system", "tool", "", "usher", None], ["Hello there.", "no end", "", " \t", "Why?\n", "a.b", None, "So!"]
    turns = [rng.choice([k, k, k, rng.randint(0, 6), None]) for k in range(n)]
    return [(conv, t, rng.choice(roles), rng.choice(texts)) for t in turns]


def test_spans_give_the_least_edits():
    """The chart against every edit script, whole and cut at every place."""
    rng = random.Random(2)
    for k in range(250):
        rows = sorted(plain_damage(conversation(rng, k, rng.randint(0, 4))), key=plain_order)
        want = plain_repair(rows)
        assert repair.repaired([r[1:] for r in rows]) == want, rows


CONV_SCHEMA = "conv_id long, turn long, role string, text string, name int, gone int, tie string, cost int"


def test_repair_over_awkward_tables(spark):
    rng = random.Random(4)
    rows = [r for conv in [*range(60), None] for r in conversation(rng, conv, rng.randint(1, 4))]
    long = [(99, k, rng.choice(["user", "assistant"]), rng.choice(["Yes.", f"t{k}.", "open"])) for k in range(3000)]
    rows += long + [(77, 5, "user", "same.")] * 300 + [(78, 1, "user", "very long " * 20_000 + ".")]
    gone = next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "dropped")]
    df = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], CONV_SCHEMA).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.conv_id: tuple(r)[1:] for r in repair.repair(df).collect()}
        short = {r.conv_id: tuple(r)[1:] for r in repair.repair(df, repair.Params(most_rows=2, salts=3)).collect()}
        tight = {r.conv_id: tuple(r)[1:] for r in repair.repair(df, repair.Params(most_chars=0)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert set(got) == {r[0] for r in rows} and got == short == tight
    for conv in got:
        mine = sorted(plain_damage([r for r in rows if r[0] == conv]), key=plain_order)
        if len(mine) <= 5:
            assert got[conv] == plain_repair(mine), conv
        else:
            assert got[conv] == repair.repaired([r[1:] for r in mine])
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.repair(spark.createDataFrame([], CONV_SCHEMA)).count() == 0
