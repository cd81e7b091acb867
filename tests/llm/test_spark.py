"""The operators as Spark jobs over awkward tables, against plain code."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import backoff, components, language, mixing, neardup, neighbours, passages, pii, quality, rules, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, node string, key long, size int"


def rows_of(texts):
    """Documents (id, text) with sources, and columns whose names the operators use themselves."""
    return [(i, t, "en", None if k % 5 == 4 else f"s{k % 3}", 1, False, 0.5, "n", 3, 9) for k, (i, t) in enumerate(texts)]


def awkward():
    rng = random.Random(5)
    base = [rng.choice(["alpha", "beta", "gamma", "delta", "stone", "river"]) + str(rng.randint(0, 60)) for _ in range(200)]
    near = base[:190] + ["other"] * 2 + base[192:]
    passage = " ".join(f"p{k}" for k in range(60))
    long = " ".join(f"word{k % 5003} x{k % 77}" for k in range(100_000))
    return [
        (1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base).upper()), (3, " ".join(base).upper()),
        (4, None), (5, ""), (6, " \n\t "), (None, "no id here"), (None, None), (7, "one"), (8, "one"), (9, "One two"),
        (10, long), (11, "before it " + passage + " after"), (12, passage + "\n" + "tail " * 30), (13, "For For " * 40),
        (14, "mail jo.doe@mail.example.com or +1 (017) 555-7713 now"), (15, "again jo.doe@mail.example.com !"),
        (16, "line one two\nline one two\n\nline one two"), (16, "another text of the same id"),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(awkward()), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, int(k % 2), 0, "x") for k in range(1, 14)] + [(None, 1, 0, "x"), (3, None, 0, "x")],
                                 "doc_id long, quality int, toxic int, text string")


def shingle_set(text, k):
    words = WORD.findall((text or "").translate(neardup._UPPER))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def plain_components(texts, k):
    """Smallest id reachable for every row, comparing all pairs."""
    sets = [shingle_set(t, k) for _, t in texts]
    group = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            old, new = group[a], group[b]
            group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(texts, group, strict=True):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [(i, len(s), least.get(g) if s else i) for (i, _), s, g in zip(texts, sets, group, strict=True)]


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_are_those_of_all_pairs(docs, k):
    got = [tuple(r) for r in neardup.near_duplicates(docs, neardup.Params(k=k)).collect()]
    want = [(*r, r[0] == r[2]) for r in plain_components(awkward(), k)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_near_copies_of_many_degrees(spark):
    """A family with all similarities around the threshold, some linked only through others."""
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 500)}" for _ in range(300)]
    texts = []
    for k in range(120):
        words = list(base)
        for _ in range(rng.randint(0, 40)):
            words[rng.randrange(300)] = f"v{rng.randint(0, 9999)}"
        texts.append((k, " ".join(words)))
    got = neardup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), neardup.Params(k=2)).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(plain_components(texts, 2))


def plain_keep_one(texts):
    """The rows that stay: of each group its first by id (none last), of an id's texts one, of equal rows one."""
    sets = [shingle_set(t, 5) for _, t in texts]
    group = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            old, new = group[a], group[b]
            group = [new if g == old else g for g in group]
    wordless = [(i, t) for (i, t), s in zip(texts, sets, strict=True) if not s]
    groups = {}
    for (i, t), s, g in zip(texts, sets, group, strict=True):
        if s:
            groups.setdefault(g, set()).add((i is None, i, t))
    return wordless, [{(i, t) for none, i, t in rows if (none, i) == min((n, k) for n, k, _ in rows)} for rows in groups.values()]


def test_keep_one_keeps_columns_and_one_of_each_group(spark, docs, empty):
    words = [f"w{k}" for k in range(60)]
    near = words[:59] + ["x"]
    more = [(None, "five equal texts that have no id at all")] * 5 + [(30, " ".join(words)), (31, " ".join(near)), (31, "another text of 31 altogether")]
    for texts, table in ((awkward(), docs), (more, spark.createDataFrame(rows_of(more), SCHEMA).repartition(2))):
        kept = neardup.keep_one(table)
        assert kept.columns == table.columns
        got = [(r.doc_id, r.text) for r in kept.collect()]
        wordless, groups = plain_keep_one(texts)
        assert sorted((r for r in got if not WORD.search(r[1] or "")), key=str) == sorted(wordless, key=str)
        rest = [r for r in got if WORD.search(r[1] or "")]
        assert len(rest) == len(groups) and all(any(r in g for r in rest) for g in groups)
    assert neardup.keep_one(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (3, 2), (500, 499)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)} | {499: 499, 500: 499}


def test_mixing_meets_its_targets(spark, docs, empty):
    sized = docs.select("doc_id", "source", mixing.count_words(F.col("text")).alias("size"))
    got = mixing.mix_sources(sized, mixing.Params(range_rows=2)).collect()
    assert len(got) == len(awkward())
    by = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        by.setdefault(r.source, []).append(r)
    sizes = {s: sum(r["size"] for r in rs) for s, rs in by.items()}
    names = sorted((s for s in by if s is not None)) + [None] * (None in by)
    weights = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if 3 * sizes[s] < level * weights[s]}
        for s in over or open_:
            target[s] = 3.0 * sizes[s] if over else level * weights[s]
        if not over:
            break
        left -= sum(target[s] for s in over)
        open_ -= over
    for s, rs in by.items():
        assert rs[0].source_size == sizes[s] and abs(rs[0].target - target[s]) < 1e-6 * max(1, target[s])
        assert abs(sum(r.taken for r in rs) - target[s]) <= 2
    again = mixing.mix_sources(sized.repartition(7), mixing.Params(range_rows=50)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix_sources(empty).count() == 0


def test_repeated_rows_follow_the_mix(docs, empty):
    out = mixing.repeat_to_mix(docs)
    assert out.columns == docs.columns
    taken = mixing.mix_sources(docs.select("doc_id", "source", mixing.count_words(F.col("text")).alias("size"))).where("size > 0")
    want = sorted(str((r.doc_id, r.source, r["size"])) for r in taken.collect() for _ in range(int(r.taken / r["size"] + 0.5)))
    got = sorted(str((r.doc_id, r.source, len(WORD.findall(r.text)))) for r in out.collect())
    assert got == want
    assert mixing.repeat_to_mix(empty).count() == 0


def test_surrogates_are_distinct_and_coherent(spark, docs, empty):
    names = [(k, f"Mr. {a} {b}" + " text") for k, (a, b) in enumerate(itertools.product(pii.MALE, [f"Family{c}" for c in "abcdefghijklmnopqrstuvwxyz"]))]
    made = {r.doc_id: r.text for r in pii.surrogates(spark.createDataFrame(names, "doc_id long, text string")).collect()}
    given, family = {}, {}
    for k, text in names:
        _, a, b, *_ = text.split()
        _, x, y, *_ = made[k].split()
        assert given.setdefault(a, x) == x and family.setdefault(b, y) == y
    assert len(set(given.values())) == len(given) and len(set(family.values())) == len(family)
    assert not set(given) & set(given.values())
    out = pii.with_surrogates(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.where("doc_id in (14, 15)").collect()}
    mails = [re.search(r"\S+@\S+", t).group() for t in texts.values()]
    assert mails[0] == mails[1] != "jo.doe@mail.example.com" and "555-7713" not in texts[14]
    same = [(i, t) for i, t in awkward() if i not in (14, 15)]
    assert sorted(str((r.doc_id, r.text)) for r in out.where("doc_id is null or doc_id not in (14, 15)").collect()) == sorted(map(str, same))
    assert pii.with_surrogates(empty).count() == 0


def test_no_entity_is_left_and_the_key_is_the_sessions(spark, docs):
    """Every plain form that a text's entities have is gone from it; a configured key gives the same text again."""
    rng = random.Random(9)
    people = ["Mr. Jon Farrow", "Mrs Ilse Brandt", "Dr. Okafor", "Peter Quill"]
    parts = ["x@y.example.com", "+1 (017) 555-7713", "97.51.17.173", "4111-1111-1111-1111", "020 7946 0958", "GB82 WEST 1234 5698 7654 32", "token=abcd1234efgh", *people]
    texts = [(k, ". ".join(rng.sample(parts, 4)) + ". Farrow met Brandt, Okafor, Quill and Ilse") for k in range(60)]
    table = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    made = {r.doc_id: r.text for r in pii.surrogates(table, key="mine").collect()}
    for k, text in texts:
        for form in {text[a:b] for a, b, _ in pii.find(text)}:
            assert not re.search(rf"(?<!\w){re.escape(form)}(?!\w)", made[k]), (form, made[k])
    assert {r.doc_id: r.text for r in pii.surrogates(table, key="mine").collect()} == made
    assert {r.doc_id: r.text for r in pii.surrogates(table, key="other").collect()} != made
    assert pii.session_key(spark) == pii.session_key(spark) == spark.conf.get(pii.SETTING) and len(pii.session_key(spark)) >= 32


def test_surrogates_end_where_few_or_none_are_free(spark):
    texts = ["password: ********", "Token:\n==========", "ask _@_.org or __@-.net"] + [f"secret: *******{k}" for k in range(10)]
    made = [r.text for r in pii.surrogates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert made[:2] == texts[:2] and "_@_.org" not in made[2].split() and "__@-.net" not in made[2].split()
    assert len(set(made[3:])) == 10 and not set(made[3:]) & set(texts)


def test_tokens_round_trip(docs, empty):
    got = tokens.encoded(docs.select("doc_id", F.col("text").alias("kept"), F.lit("x").alias("ids"), "text")).withColumnRenamed("kept", "text")
    for r in got.withColumn("back", tokens.texts(got)).collect():
        text = (r.text or "").encode()
        assert bytes(r.back) == text and len(r.ids) == r.n_tokens
        assert r.decoded_sha256 == hashlib.sha256(text).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(b"".join(int(i).to_bytes(4, "little") for i in r.ids)).hexdigest()
    assert got.count() == len(awkward()) and tokens.encoded(empty).count() == 0
    assert tokens.encoded(docs, keep_ids=False).columns == ["doc_id", "lang", "source", "n_chars", "kept", "score", "node", "key", "size", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_quality_over_odd_tables(docs, empty, labels):
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    got = docs.select("doc_id", quality.score(docs, quality.train(docs, labels)).alias("s")).collect()
    assert len(got) == len(awkward()) and all(0 <= r.s <= 1 for r in got)
    assert quality.keep_good(docs, labels.limit(0)).count() == docs.count()  # nothing learned, nothing rejected
    assert quality.keep_good(empty, labels).count() == 0


def test_language_over_odd_tables(docs, empty):
    found = docs.select("doc_id", "text", language.identify(docs, language.train(docs)).alias("m")).select("doc_id", "text", "m.*").collect()
    for r in found:
        assert r.lang_pred == ("en" if re.search(r"[^\W\d_]", r.text or "") else "und") and 0 <= r.score <= 1
    none = language.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.m.lang_pred for r in docs.select(language.identify(docs, none).alias("m")).collect()} == {"und"}
    assert empty.select(language.identify(empty, language.train(empty)).alias("m")).count() == 0


def test_no_language_is_lost_to_length(spark):
    long = "der fluss und die kleine stadt am berg " * 210
    rows = [(k, f"{long} nummer {k}", "de") for k in range(60)] + [(100 + k, f"the river and the town number {k}", "en") for k in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(table)
    assert model.languages == ("de", "en")
    got = table.select("lang", language.identify(table, model).alias("m")).collect()
    assert all(r.m.lang_pred == r.lang for r in got)


def test_long_texts_teach_quality(spark):
    good, bad = "a calm and useful text about the river ", "buy now $$$ click here free free "
    rows = [(k, (good if k % 2 else bad) * 900) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(k, 1) for k in range(1000, 9000)], "doc_id long, quality int")
    sample = quality.training_sample(docs, labels, quality.Params())
    assert sample.count() >= 40 and sample.select(F.max(F.length("text"))).first()[0] == 20_000
    kept = {r.doc_id for r in quality.keep_good(docs, labels).collect()}
    assert kept == {k for k in range(60) if k % 2}


def test_many_good_labels_move_no_text(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    plans = []

    def caught(df, name, **options):
        if name == "buckets":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, name, **options)

    keep, rules.settle = rules.settle, caught
    try:
        rules.ratios(docs, spark.range(200_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality")))
    finally:
        rules.settle = keep
    assert "BroadcastHashJoin" in plans[0] and "hashpartitioning(doc_id" not in plans[0]


def plain_rules(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    again = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    return (len(words), sum(map(len, words)), sum(c in rules.SYMBOLS for c in text), len(lines) - len(set(lines)), len(again),
            len(words) < 20 or 100 * len(again) > 30 * len(words))


def test_rules_are_those_of_plain_code(docs, empty, labels):
    judged = rules.judge(docs, rules.ratios(docs, labels))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for r in judged.collect():
        assert tuple(r[n] for n in names) == plain_rules(r.text), r.doc_id
        assert r.kept is not None and not (r.kept and r.base_failed)
    table = rules.ratios(docs, labels)
    plain = {}
    good = {k for k in range(1, 14) if k % 2}
    for i, t in awkward():
        words = WORD.findall(t or "")
        for gram in words + [f"{a} {b}" for a, b in itertools.pairwise(words)]:
            raw, target = plain.setdefault(zlib.crc32(gram.encode()) % 65536, [0, 0])
            plain[zlib.crc32(gram.encode()) % 65536] = [raw + 1, target + (i in good)]
    raw, target = (sum(x[k] for x in plain.values()) for k in (0, 1))
    import math

    for b in random.Random(1).sample(range(65536), 500):
        r, t = plain.get(b, (0, 0))
        assert abs(table[b] - 1e6 * math.log((t + 1) * (raw + 65536) / ((target + 65536) * (r + 1)))) <= 0.5001
    assert set(rules.ratios(docs, labels.limit(0))) == {0} and rules.judge(empty, [0] * 65536).count() == 0


def test_rules_learn_from_every_good_label(spark):
    docs = spark.range(10_500).select(F.col("id").alias("doc_id"), F.lit("good").alias("text"))
    docs = docs.unionByName(spark.range(20_000, 20_500).select(F.col("id").alias("doc_id"), F.lit("poor").alias("text")))
    table = rules.ratios(docs, spark.range(10_500).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality")))
    import math

    want = round(1e6 * math.log(10_501 * (11_000 + 65_536) / ((10_500 + 65_536) * 10_501)))
    assert abs(table[zlib.crc32(b"good") % 65_536] - want) <= 1


def test_passages_are_those_of_all_windows(docs, empty):
    from test_plain import _covered

    want = _covered([t or "" for _, t in awkward()], 50)
    got = passages.repeated_passages(docs).collect()
    plain = sorted(str((i, len(WORD.findall(t or "")), len(c))) for (i, t), c in zip(awkward(), want, strict=True))
    assert sorted(str((r.doc_id, r.n_words, r.n_repeated)) for r in got) == plain
    assert passages.repeated_passages(empty).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_of_mixed_copies(spark, seed):
    """Texts pasted together from pieces of one another, so that copies overlap in all ways."""
    from test_plain import _covered

    rng = random.Random(seed)
    pool = [f"w{k}" for k in range(400)]
    texts = []
    for k in range(60):
        words = []
        while len(words) < 150:
            at, n = rng.randrange(380), rng.randint(5, 70)
            words += pool[at : at + n] if rng.random() < 0.6 else [f"u{rng.random()}" for _ in range(rng.randint(1, 20))]
        texts.append((k, " ".join(words)))
    got = passages.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string").repartition(4), passages.Params(least=20, gram=5))
    want = _covered([t for _, t in texts], 20)
    assert {r.doc_id: r.n_repeated for r in got.collect()} == {k: len(c) for k, c in enumerate(want)}


@pytest.mark.parametrize("p", [backoff.Params(), backoff.Params(order=1), backoff.Params(order=2, slices=1), backoff.Params(order=4, slices=3, chunk_words=300)])
def test_backoff_is_that_of_plain_counts(docs, empty, p):
    """Each text by the counts of all other rows, n-gram by n-gram."""
    import math
    from collections import Counter

    texts = [WORD.findall(t or "") for _, t in awkward()]
    counts = [Counter(tuple(t[i : i + n]) for n in range(1, p.order + 1) for i in range(len(t) - n + 1)) for t in texts]
    every, total = sum(counts, Counter()), sum(map(len, texts))

    def word(gram, own, words):
        if not gram:
            return math.log(p.alpha) - math.log(max(1, total - words))
        if every[gram] > own[gram]:
            below = every[gram[:-1]] - own[gram[:-1]] if len(gram) > 1 else total - words
            return math.log((every[gram] - own[gram]) / below)
        return word(gram[1:], own, words) + (math.log(p.alpha) if len(gram) > 1 else 0)

    got = sorted((str((r.doc_id, r.n_words)), r.lm_score) for r in backoff.score(docs, p).collect())
    want = [(str((i, len(ws))), sum(word(tuple(ws[max(0, k + 1 - p.order) : k + 1]), own, len(ws)) for k in range(len(ws))) / len(ws) if ws else None)
            for (i, _), ws, own in zip(awkward(), texts, counts, strict=True)]
    assert len(got) == len(want)
    for (a, x), (b, y) in zip(sorted(got, key=str), sorted(want, key=str), strict=True):
        assert a == b and (x is None) == (y is None) and (x is None or abs(x - y) < 2e-6)
    assert backoff.score(empty, p).count() == 0


def test_copies_tell_each_other(spark):
    """A text that occurs twice is told by its copy; one that is alone backs off."""
    rng = random.Random(6)
    texts = [(k, " ".join(f"w{rng.randint(0, 400)}" for _ in range(80))) for k in range(40)]
    got = {r.doc_id: r.lm_score for r in backoff.score(spark.createDataFrame([*texts, (100, texts[7][1])], "doc_id long, text string").repartition(3)).collect()}
    assert got[7] == got[100] > -0.5 > -4 > max(v for k, v in got.items() if k not in (7, 100))


def test_neighbours_over_odd_vectors(spark):
    rng = random.Random(3)
    made = [(k, [rng.gauss(0, 1) for _ in range(8)], k) for k in range(600)]
    made += [(1000 + k, made[0][1], 0) for k in range(30)] + [(5, made[5][1], 0)]
    odd = [(2000, None, 1), (2100, [], 1), (2200, [0.0] * 8, 1), (2300, [None] + [1.0] * 7, 1), (2400, [float("nan")] * 8, 1),
           (2500, [float("inf")] * 8, 1), (None, [1.0] * 8, 1), (2600, [1.0, 2.0], 1), (2601, [1.0, 3.0], 1)]
    table = spark.createDataFrame(made + odd, "vec_id long, embedding array<double>, shard int")
    got = neighbours.search(table, table.where("vec_id % 100 = 0"), neighbours.Params(shard_bytes=64_000, block_bytes=1000)).collect()
    good = made + odd[-2:]
    hits = all_ = 0
    for q in sorted({k for k, *_ in good if k % 100 == 0}):
        vector = next(v for k, v, _ in good if k == q)
        want = sorted((sum((a - b) ** 2 for a, b in zip(vector, v, strict=True)) ** 0.5, k) for k, v, _ in good if k != q and len(v) == len(vector))[:10]
        mine = sorted((r.rank, r.score, r.vec_id) for r in got if r.query_id == q)
        assert [r for r, *_ in mine] == list(range(1, len(want) + 1))
        assert [(s, k) for _, s, k in mine] == sorted((s, k) for _, s, k in mine)
        hits += len({k for _, k in want} & {k for *_, k in mine})
        all_ += len(want)
    assert hits >= 0.95 * all_
    assert {r.query_id for r in got} == {k for k, *_ in good if k % 100 == 0}
    assert neighbours.search(table.limit(0), table.limit(0)).count() == 0
