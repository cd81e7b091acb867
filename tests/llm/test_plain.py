"""The numpy and text parts of the operators against plain code."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import grams, hnsw, language, neardup, passages, pii, quality, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.text(alphabet="ab é\n\tZ日", max_size=40), max_size=6)


@given(TEXTS)
@settings(max_examples=60, deadline=None)
def test_word_hashes_tell_words_apart(texts):
    found = grams.word_hashes(texts)
    named = {}
    for text, hashes in zip(texts, found, strict=True):
        words = WORD.findall(text)
        assert len(words) == len(hashes)
        for word, h in zip(words, hashes.tolist(), strict=True):
            assert named.setdefault(word, h) == h
    assert len(set(named.values())) == len(named)


def test_pieces_of_a_long_text_give_the_same_hashes():
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdé", k=rng.randint(1, 9))) for _ in range(5000))
    whole = grams.word_hashes([text])[0]
    assert len(grams.cuts(text, 100)) > 100 and "".join(grams.cuts(text, 100)) == text
    parts = [h for piece in grams.cuts(text, 100) for h in grams.word_hashes([piece])[0]]
    assert whole.tolist() == parts


@given(TEXTS)
@settings(max_examples=40, deadline=None)
def test_shingles_are_the_sets_of_word_tuples(texts):
    lower = [t.translate(neardup._UPPER) for t in texts]
    for text, found in zip(lower, neardup.shingle_sets(texts, 2), strict=True):
        words = WORD.findall(text)
        plain = {tuple(words[i : i + 2]) for i in range(len(words) - 1)} or ({tuple(words)} if words else set())
        assert len(found) == len(plain)


def test_estimate_follows_similarity():
    p = neardup.Params(k=2)
    rng = np.random.default_rng(3)
    factors = rng.integers(1, 1 << 63, 2048, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    terms = rng.integers(0, 1 << 63, 2048, dtype=np.uint64)
    base = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    other = np.concatenate([base[:889], rng.integers(0, 1 << 63, 111, dtype=np.uint64)])
    a, b = (grams.mix(neardup.minima(x, factors, terms)) & np.uint64(15) for x in (base, other))
    equal = (a == b).mean()
    assert abs((equal - 1 / 16) / (15 / 16) - 889 / 1111) < 0.05
    assert p.least < 128 * (0.8 + 0.2 / 16)


def _covered(texts, least):
    """Word places in runs of ``least`` words that occur twice, by looking at every window."""
    words = [WORD.findall(t) for t in texts]
    seen = {}
    for row, ws in enumerate(words):
        for i in range(len(ws) - least + 1):
            seen.setdefault(tuple(ws[i : i + least]), []).append((row, i))
    out = [set() for _ in texts]
    for places in seen.values():
        if len(places) > 1:
            for row, i in places:
                out[row].update(range(i, i + least))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equal_windows_choose_equal_minimisers(seed):
    rng = random.Random(seed)
    p = passages.Params(least=12, gram=3)
    shared = [str(rng.random()) for _ in range(12)]
    places = []
    for _ in range(2):
        words = [str(rng.random()) for _ in range(rng.randint(0, 30))] + shared + [str(rng.random()) for _ in range(20)]
        at = words.index(shared[0])
        chosen, _ = passages.minimisers(grams.word_hashes([" ".join(words)])[0], p)
        places.append({int(c) - at for c in chosen if 0 <= c - at <= 9})
    assert places[0] & places[1]


def test_pii_is_found_and_replaced_by_type():
    text = ("Mail Jane.Doe34@Mail7.example.com, call +1 (017) 555-7713 or +10175557713; 97.51.17.173, card 4111-1111-1111-1111, "
            'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962", 123-45-6789, GB82 WEST 1234 5698 7654 32. Mr. John Smith met Frau Müller; господин Петров.')
    made, n = pii.rewrite(text, {}, "own key")
    kinds = [k for *_, k in pii.find(text)]
    assert kinds == ["email", "phone", "phone", "ip", "card", "secret", "ssn", "iban", "given_m", "family", "family", "family"] and n == 12
    for a, b, _ in pii.find(text):
        assert text[a:b] not in made
    again = pii.find(made)
    assert [k for *_, k in again][:8] == kinds[:8]
    mentions = [made[a:b] for a, b, _ in again]
    assert re.sub(r"\D", "", mentions[1]) == re.sub(r"\D", "", mentions[2])  # one number, two formats
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", mentions[1])
    assert pii._luhn(mentions[4].replace("-", "")) == 0 and re.fullmatch(r"(\d{4}-){3}\d{4}", mentions[4])
    assert pii._rest_97(mentions[7].replace(" ", "")) == 1
    assert re.fullmatch("[0-9a-f]{40}", mentions[5])
    assert "Mr. " in made and any(f"Mr. {name} " in made for name in pii.MALE)
    assert re.search("[а-я]", made.split("господин")[1])


def test_pii_leaves_plain_texts_alone():
    for text in ("", "The price rose to 12 or 13.5 in 2024.", "Version 2.0.1 of Mark and General Public", "a@b", "x: y = z"):
        assert pii.rewrite(text, {}, "own key") == (text, 0)


@pytest.mark.parametrize("text, names", [
    ("Mr Smith came. Smith left, and SMITH's hat too; Smithson stayed.", ["Smith", "SMITH"]),
    ("Dr. Anna Weber; Weber said that Anna knew.", ["Anna", "Weber"]),
    ("Smith asked Mr. Smith's brother.", ["Smith"]),
    ("господин Петров ушёл, Петров пришёл", ["Петров"]),
    ("Dr Παπαδόπουλος και Παπαδόπουλος", ["Παπαδόπουλος"]),
])
def test_later_mentions_follow_the_first(text, names):
    made, _ = pii.rewrite(text, {}, "own key")
    for name in names:
        assert not re.search(rf"(?<!\w){name}(?!\w)", made), made
    mine = dict(zip([text[a:b].lower() for a, b, _ in pii.find(text)], [None] * 99, strict=False))
    drawn = [pii.shaped(k, text[a:b], pii.surrogate(k, pii.plain(k, text[a:b]), 0, "own key")) for a, b, k in pii.find(text)]
    assert len({d.lower() for d in drawn}) == len(mine) and all(d in made for d in drawn)
    assert ("Smithson" in made) == ("Smithson" in text)


def test_national_numbers():
    for number in ("020 7946 0958", "06 12 34 56 78", "06.12.34.56.78", "(0161) 496 0123", "0171-1234567", "0049 30 901820"):
        made, n = pii.rewrite(f"call {number} now", {}, "own key")
        assert n == 1 and number not in made and re.sub(r"\d", "0", made) == re.sub(r"\d", "0", f"call {number} now")
        assert [k for *_, k in pii.find(f"call {number} now")] == ["phone"] and made[5:7].strip("(")[0] == "0"
    for text in ("on 01.02.2024 or 05-06-24", "0123 45", "from 02 to 07", "0.5 1.25", "at 09:30"):
        assert pii.rewrite(text, {}, "own key") == (text, 0)


def test_another_key_draws_other_surrogates():
    for kind, entity in (("email", "jo.doe@mail.example.com"), ("phone", "10175557713"), ("secret", "abcdef0123456789"), ("ip", "97.51.17.173")):
        assert len({pii.surrogate(kind, entity, 0, key) for key in ("a", "b", "c")}) == 3


def test_masked_values_are_no_secrets():
    for text in ("password: ********", "Token:\n==========", "secret: ........."):
        assert pii.rewrite(text, {}, "own key") == (text, 0)
    assert pii.rewrite("password: *******7", {}, "own key")[1] == 1


def test_surrogates_grow_until_one_is_free():
    for kind, entity in (("email", "_@_.org"), ("secret", "*******7"), ("secret", "********"), ("phone", "1234")):
        drawn = [pii.surrogate(kind, entity, k, "own key") for k in range(40)]
        assert len(set(drawn[-30:])) == 30 and entity not in drawn[-30:]
        assert pii.shaped(kind, entity, drawn[-1]) == drawn[-1]


@pytest.mark.parametrize("name", ["Παπαδόπουλος", "الخطيب", "כהןלוי", "शर्मा", "王小明", "გიორგაძე", "Հակոբյան", "สมชาย", "김민수", "さくら"])
def test_names_keep_their_script(name):
    text = f"Dr. {name}, Mrs {name} {name}."
    made, n = pii.rewrite(text, {}, "own key")
    words = re.findall(r"[^ .,]+", made)
    assert n == 3 and len(words) == 5 and (words[0], words[2]) == ("Dr", "Mrs")
    for word in (words[1], words[3], words[4]):
        assert word != name and len(word) == len(name)
        assert [pii._script(c) for c in word] == [pii._script(c) for c in name]
    assert words[1] == words[4]


def test_long_addresses_are_replaced_whole():
    local = "jane.doe." * 12 + "z"
    made, n = pii.rewrite(f"to {local}@mail.example.com now", {}, "own key")
    assert n == 1 and "jane" not in made and made.startswith("to ") and made.endswith(".com now")


def test_redrawn_surrogates_differ():
    for kind, entity in (("family", "smith"), ("given_f", "anna"), ("email", "a@b.org"), ("phone", "10175557713"), ("ip", "1.2.3.4")):
        assert len({pii.surrogate(kind, entity, k, "own key") for k in range(4)}) >= 3


@pytest.fixture(scope="module")
def enc():
    return tokens.encoding(tokens.rank_file(public_tokenizers.path(tokens.RANKS)), public_tokenizers.PATTERN)


@given(st.text(alphabet="ab1 \n\t\x1c  é'!s日😀", max_size=400))
@settings(max_examples=120, deadline=None)
def test_cut_texts_encode_as_whole(enc, text):
    pieces = list(tokens.parts(text, 5))
    assert "".join(pieces) == text
    assert [i for part in pieces for i in enc.encode_ordinary(part)] == enc.encode_ordinary(text)
    assert tokens.decode(tokens.encode(text, enc), enc) == text.encode()


def by_match(text, enc):
    import regex

    return [i for m in regex.finditer(public_tokenizers.PATTERN, text) for i in enc._encode_single_piece(m.group())]


@pytest.mark.parametrize("run", [" ", "\n", "\t\u3000 \xa0"])
@pytest.mark.parametrize("size", [4095, 4096, 4097, 2_000_000])
def test_long_white_space_is_one_match(enc, run, size):
    blank = (run * size)[:size]
    for text in (blank, blank + "word", "a " + blank, "one\n" + blank + "x " + blank + "\x1c", blank + "'s" + blank[:5000] + "7"):
        assert tokens.encode(text, enc).tolist() == by_match(text, enc)
        if size < 10_000:
            assert tokens.encode(text, enc).tolist() == enc.encode_ordinary(text)


def test_other_long_runs(enc):
    for text in ("a" * 300_000, "-" * 300_000 + " x", "1" * 300_000, "é日" * 100_000 + " \n"):
        assert tokens.encode(text, enc).tolist() == enc.encode_ordinary(text)


def test_batches_are_encoded_a_few_rows_at_a_time():
    import pyarrow as pa

    texts = [None, "", "x" * 3_000_000, "é" * 600_000] + ["word " * 40] * 1000 + [None] * 300
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    got = list(tokens.few(batch, 1))
    assert [t for part in got for t in part.column(1).to_pylist()] == texts
    assert all(part.num_rows <= 256 for part in got)
    assert all(part.num_rows == 1 or sum(len((t or "").encode()) for t in part.column(1).to_pylist()) <= tokens.STEP_BYTES for part in got)


def test_null_and_special_texts(enc):
    assert tokens.encode(None, enc).tolist() == [] and tokens.decode(tokens.encode("", enc), enc) == b""
    assert tokens.decode(tokens.encode("<|endoftext|> x", enc), enc) == b"<|endoftext|> x"
    assert isinstance(enc, tiktoken.Encoding)


def test_quality_learns_and_survives_odd_input():
    rng = random.Random(2)
    good = [" ".join(rng.choices(["river", "stone", "green", "walks", "slowly"], k=30)) for _ in range(40)]
    bad = [" ".join(w + "$$$" for w in rng.choices(["river", "stone", "green"], k=30)) for _ in range(40)]
    p = quality.Params(bits=12)
    weights = quality.fit(good + bad, [1] * 40 + [0] * 40, p)
    scored = quality.predict([good[0], bad[0], "", None, "x" * 500_000, "\n\n"], weights, p)
    assert scored[0] > 0.8 and scored[1] < 0.2 and np.isfinite(scored).all()
    assert quality.predict(["a"], quality.fit([], [], p), p)[0] == 0.5
    assert quality.predict(["a"], quality.fit(["b"], [1], p), p)[0] > 0.9


def test_quality_of_a_long_text_is_that_of_the_whole():
    p = quality.Params(bits=12)
    weights = np.random.default_rng(1).normal(size=(1 << 12) + 1).astype(np.float32)
    text = " ".join(f"w{k % 97}" for k in range(2000))
    bag = quality.bags([text], p)[0]
    plain = 1 / (1 + np.exp(-(weights[bag].astype(float).mean() + float(weights[-1]))))
    assert abs(quality.predict([text], weights, p)[0] - plain) < 1e-9


def test_language_kernel_is_the_share_of_common_grams():
    p = language.Params(most=3, bits=24)
    texts = ["ab ba", "ab bc", "zz", ""]
    columns = np.unique(np.concatenate([h for h, _ in language._grams(texts, p)])).astype(np.int64)
    held, sizes = language.presence(texts, columns, p)

    def plain(text):
        out = set()
        for word in text.split():
            padded = f" {word} "
            out |= {padded[i : i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1)}
        return out - {" "}

    sets = [plain(t) for t in texts]
    want = [[len(a & b) / max(1, len(a)) ** 0.5 / max(1, len(b)) ** 0.5 for b in sets] for a in sets]
    assert sizes.tolist() == [len(s) for s in sets]
    assert np.allclose(language.kernel(held, sizes, held), want)
    some = columns[::2]  # n-grams that no landmark has count in a text's own number
    assert language.presence([*texts, "ab bc " * 100_000], some, p)[1].tolist() == [*sizes.tolist(), len(plain("ab bc"))]


def test_language_learns_and_knows_what_has_no_letter():
    rng = random.Random(4)
    made = {n: [" ".join(rng.choices(ws, k=8)) for _ in range(30)] for n, ws in
            {"en": ["the", "and", "with", "river"], "de": ["und", "der", "mit", "fluss"]}.items()}
    texts, names = made["en"] + made["de"], ["en"] * 30 + ["de"] * 30
    p = language.Params(landmarks=8)
    model = language.fit(texts, names, p)
    found, scores = language.predict(["the river", "der fluss und", None, "123 !!", "", "THE RIVER " * 60_000], model, p)
    assert found == ["en", "de", "und", "und", "und", "en"] and ((scores >= 0) & (scores <= 1)).all()
    assert language.predict(["the"], language.fit([], [], p), p)[0] == ["und"]


def test_totals_of_keys_that_several_chunks_hold():
    import pyarrow as pa

    from tidemark.llm import backoff

    rng = np.random.default_rng(5)
    rows = []
    for chunk in range(9):
        keys = np.unique(np.append(rng.integers(-50, 50, 40), [7, -(1 << 63), (1 << 63) - 1][: chunk % 4]))
        rows.append((chunk, 100 * chunk, keys.tolist(), rng.integers(1, 5, len(keys)).tolist()))
    rows.append((9, 0, [], []))
    table = pa.table({name: [r[k] for r in rows] for k, name in enumerate(("chunk", "first", "keys", "counts"))},
                     pa.schema([("chunk", pa.int64()), ("first", pa.int64()), ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32()))]))
    total = {}
    for _, _, keys, counts in rows:
        for k, n in zip(keys, counts, strict=True):
            total[k] = total.get(k, 0) + n
    got = backoff._shares(table).to_pylist()
    for (chunk, first, keys, counts), r in zip(rows, got, strict=True):
        want = [(first + i, total[k]) for i, (k, n) in enumerate(zip(keys, counts, strict=True)) if total[k] > n]
        assert r["chunk"] == chunk and list(zip(r["places"], r["totals"], strict=True)) == want
    assert backoff._shares(table.slice(9)).to_pylist() == [{"chunk": 9, "places": [], "totals": []}]


def test_graph_search_finds_the_nearest():
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(3000, 16)).astype(np.float32)
    vectors[1000:1300] = vectors[0]  # copies
    ids = np.arange(3000)
    graph = hnsw.build(ids, vectors)
    queries = ids[::100]
    own, found, far = hnsw.nearest(graph, queries, vectors[queries], 10)
    hits = 0
    for q in queries:
        want = sorted((float(np.sqrt(((vectors[q].astype(float) - vectors[k].astype(float)) ** 2).sum())), k) for k in ids if k != q)[:10]
        got = list(zip(far[own == q].tolist(), found[own == q].tolist(), strict=True))
        assert got == sorted(got)
        hits += len({k for _, k in want} & {k for _, k in got})
    assert hits >= 0.95 * 10 * len(queries)


@pytest.mark.parametrize("scale, kind", [(1e25, np.float32), (1e-25, np.float32), (1e200, np.float64), (1e-200, np.float64), (None, np.float32)])
def test_search_at_any_scale(scale, kind):
    """All ten are found, whatever the components' size, also where some are tiny beside others (None)."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(600, 8))
    vectors = (base * scale if scale else np.where(np.arange(600)[:, None] % 2, 1e20, 1e-10) * base).astype(kind)
    with np.errstate(all="raise", under="ignore"):
        own, found, far = hnsw.nearest(hnsw.build(np.arange(600), vectors), np.arange(0, 600, 7), vectors[::7], 10)
    assert np.isfinite(far).all() and (far > 0).all()
    hits = 0
    for q in range(0, 600, 7):
        exact = [(float(np.linalg.norm(vectors[q].astype(np.longdouble) - v)), k) for k, v in enumerate(vectors.astype(np.longdouble)) if k != q]
        got = found[own == q].tolist()
        assert len(got) == 10
        hits += len({k for _, k in sorted(exact)[:10]} & set(got))
    assert hits >= 0.95 * len(found)


def test_search_measures_a_part_of_the_shard(monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(50, 32))
    vectors = (centres[rng.integers(0, 50, 12_000)] + 0.7 * rng.normal(size=(12_000, 32))).astype(np.float32)
    p = hnsw.Params(search=64, seen_bytes=1 << 17)  # 87 searches at once
    assert p.together(12_000) == 87
    graph, measured, plain = hnsw.build(np.arange(12_000), vectors, p), [0], hnsw.distances
    monkeypatch.setattr(hnsw, "distances", lambda v, q, n: (measured.__setitem__(0, measured[0] + int((n >= 0).sum())), plain(v, q, n))[1])
    asked = np.arange(0, 12_000, 100)
    own, found, _ = hnsw.nearest(graph, asked, vectors[asked], 10, p)
    assert measured[0] / len(asked) < 0.15 * 12_000
    hits = 0
    for q in asked:
        far = ((vectors - vectors[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        hits += len(set(np.argpartition(far, 10)[:10].tolist()) & set(found[own == q].tolist()))
    assert hits >= 0.9 * 10 * len(asked)


def test_graph_of_one_row():
    own, found, _ = hnsw.nearest(hnsw.build(np.array([7]), np.ones((1, 3))), np.array([7, 8]), np.ones((2, 3)), 10)
    assert own.tolist() == [8] and found.tolist() == [7]
