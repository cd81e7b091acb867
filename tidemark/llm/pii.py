"""Surrogates for personal data: keyed, of the same type, gender, script and format.

One pass finds the entities of all texts; their distinct forms, a small part of the corpus, get
surrogates from a keyed hash. Surrogates that two entities share, or that are an entity of the
corpus themselves, are drawn again until there are none, so different entities stay different
and mentions of one entity stay together across all documents. Only entities that had to be
drawn again are carried to the second pass, which rewrites each text where it lies. A name that a
text gives with a title or a listed given name is replaced wherever else that text has it, too.

The key decides the surrogates: who knows it can draw them again. It is the setting ``SETTING`` of
the session (its name has ``secret`` in it, so that Spark hides the value in logs); a session without one
draws a key of its own, so that only a configured key gives the same surrogates in another session.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import secrets
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, settle, small

SETTING = "spark.tidemark.surrogates.secret"


def session_key(spark) -> str:
    key = spark.conf.get(SETTING, None)
    if not key:
        key = secrets.token_hex(16)
        spark.conf.set(SETTING, key)
    return key


# Forms of address by gender, and names to draw from.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "Signor", "господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "Signora", "госпожа")
OTHER_TITLES = ("Dr", "Prof", "Professor")
MALE = ("James", "John", "Robert", "Michael", "William", "David", "Richard", "Thomas", "Peter", "Paul", "Mark", "Daniel",
        "Hans", "Klaus", "Jürgen", "Stefan", "Pierre", "Jean", "Michel", "Luc", "Carlos", "José", "Juan", "Miguel")
FEMALE = ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Sarah", "Karen", "Anna", "Emma", "Laura", "Alice",
          "Ursula", "Sabine", "Monika", "Claudia", "Marie", "Sophie", "Camille", "Julie", "María", "Carmen", "Lucía", "Elena")
MALE_CYRILLIC = ("Иван", "Пётр", "Алексей", "Дмитрий", "Сергей", "Николай", "Андрей", "Михаил")
FEMALE_CYRILLIC = ("Анна", "Мария", "Ольга", "Елена", "Наталья", "Татьяна", "Ирина", "Светлана")
ROOTS = ("Al", "Ber", "Car", "Del", "El", "Far", "Gar", "Hal", "Jor", "Kel", "Lam", "Mor", "Nor", "Or", "Per", "Ros", "Sal", "Tor", "Val", "Wen")
ENDS = ("a", "berg", "den", "er", "ez", "ford", "in", "ley", "man", "mont", "ner", "o", "son", "stein", "ton", "well")
ROOTS_CYRILLIC = ("Бел", "Вол", "Гор", "Дан", "Зим", "Кар", "Лес", "Мор", "Нов", "Пав", "Сок", "Тих")
ENDS_CYRILLIC = ("ев", "енко", "ин", "ов", "овский", "ский", "ук", "ян")

EMAIL_HOST = re.compile(r"[\w-]+(?:\.[\w-]+)+")
EMAIL_STOP = re.compile(r"[\s@<>()\[\]{},;:\"'|=]")
NUMBER = re.compile(
    r"(?<![\w.])(?:"
    r"(?P<ip>(?:[0-9]{1,3}\.){3}[0-9]{1,3})(?!\w|\.[0-9])"
    r"|(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![\w-])"
    r"|(?P<phone>\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
    r"|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}"
    r"|(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![ .-]?[0-9])"
    # as dialled inside a country: from a leading zero on, groups with one kind of gap
    r"|\(?0{1,2}[1-9][0-9]{0,4}\)?(?P<gap>[ .-])[0-9]{2,8}(?:(?P=gap)[0-9]{2,8}){0,4})(?!\w)"
    r"|(?P<card>[0-9](?:[ -]?[0-9]){12,18})(?!\w))")
TWO_DIGITS = re.compile("[0-9]{2}")  # all numbers hold two, most texts do not
IBAN = re.compile(r"(?P<iban>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b")
SECRET = re.compile(
    r"(?i:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|private[_-]?key)[\"']?\s*[=:]\s*[\"']?(?P<secret>[^\s\"',;]{8,})")
KEYLIKE = re.compile(r"(?<!\w)(?P<secret>AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9_-]{20,})")
HEXADECIMAL = re.compile("[0-9a-f]+")
# marks that letters of many scripts carry, and the joiners between them; they belong to a name as its letters do
_MARKS = "".join(c for c in map(chr, range(0x300, 0x10000)) if unicodedata.category(c)[0] == "M") + "\u200c\u200d"
_NAME = rf"[^\W\d_a-zà-ÿа-яё][\w{_MARKS}'’-]+"
_TITLES = "|".join(sorted(MALE_TITLES + FEMALE_TITLES + OTHER_TITLES, key=len, reverse=True))
_GIVEN = "|".join(sorted(MALE + FEMALE + MALE_CYRILLIC + FEMALE_CYRILLIC, key=len, reverse=True))
# without a word border in front, so that the search runs along capitals only; find() looks at what is before
PERSON = re.compile(rf"(?:(?P<title>{_TITLES})\b\.? +(?P<one>{_NAME})(?: +(?P<two>{_NAME}))?|(?P<given>{_GIVEN}) +(?P<family>{_NAME}))")
# a word that may be a title or given name, before another capital; most texts hold none that is listed
CUE = re.compile(r"[A-ZА-Яг]\w+(?=\.? +[^\W\d_a-zà-ÿа-яё])")
CUES = frozenset(MALE_TITLES + FEMALE_TITLES + OTHER_TITLES + MALE + FEMALE + MALE_CYRILLIC + FEMALE_CYRILLIC)
GENDER = dict.fromkeys(MALE_TITLES + MALE + MALE_CYRILLIC, "m") | dict.fromkeys(FEMALE_TITLES + FEMALE + FEMALE_CYRILLIC, "f")


LONGER = 4  # from this attempt on, surrogates that keep a mention's form grow, so that a free one always exists


POSSESSIVE = re.compile("['’][sS]?$")


def _number_kind(mention: str, kind: str) -> str | None:
    """The kind of a number; none if it is no address, or as national number too short."""
    if kind == "ip":
        return kind if all(int(part) < 256 for part in mention.split(".")) else None
    if kind == "phone" and mention.lstrip("(")[0] == "0":
        n = sum(c in "0123456789" for c in mention)
        return "phone" if 9 <= n <= 12 else "card" if n > 12 else None
    return kind


def _moves(text: str) -> bool:
    """Whether a text has a digit or letter, without which there is nothing to hide."""
    return any(c in "0123456789" or unicodedata.category(c)[0] == "L" for c in text)


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, type) of the entities of a text, in order and apart."""
    found: list[tuple[int, int, str]] = []
    at = text.find("@")
    while at >= 0:
        host = EMAIL_HOST.match(text, at + 1)
        if host:
            start = at
            while start and not EMAIL_STOP.match(text, start - 1):
                start -= 1
            local = text[start:at].lstrip(".")
            if local:
                found.append((at - len(local), host.end(), "email"))
        at = text.find("@", at + 1)
    if "=" in text or ":" in text:
        found += [(*m.span("secret"), "secret") for m in SECRET.finditer(text) if _moves(m["secret"])]  # not masks or ruled lines
    if "AKIA" in text or "sk-" in text or "_" in text:
        found += [(*m.span("secret"), "secret") for m in KEYLIKE.finditer(text)]
    if TWO_DIGITS.search(text):
        for m in NUMBER.finditer(text):
            kind = _number_kind(m.group(), m.lastgroup)
            if kind:
                found.append((*m.span(), kind))
        found += [(*m.span("iban"), "iban") for m in IBAN.finditer(text) if not text[max(0, m.start() - 1) : m.start()].isalnum()]
    for m in PERSON.finditer(text) if not CUES.isdisjoint(CUE.findall(text)) else ():
        if text[max(0, m.start() - 1) : m.start()].isalnum():
            continue
        if m["given"]:
            found += [(*m.span("given"), f"given_{GENDER[m['given']]}"), (*m.span("family"), "family")]
        elif m["two"]:
            sex = GENDER.get(m["one"]) or GENDER.get(m["title"], "m")
            found += [(*m.span("one"), f"given_{sex}"), (*m.span("two"), "family")]
        else:
            found.append((*m.span("one"), "family"))
    names: dict[str, str] = {}
    for k, (start, end, kind) in enumerate(found):
        if kind == "family" or kind.startswith("given"):
            end -= len(text[start:end]) - len(POSSESSIVE.sub("", text[start:end]))
            found[k] = (start, end, kind)
            for form in (text[start:end], text[start:end].upper(), text[start:end].capitalize()):
                names.setdefault(form, kind)
    if names:  # the same names, alone, anywhere in the text
        again = re.compile(rf"(?<![\w{_MARKS}])(?:{'|'.join(map(re.escape, sorted(names, key=len, reverse=True)))})(?![\w{_MARKS}])")
        found += [(*m.span(), names[m.group()]) for m in again.finditer(text)]
    out, last = [], 0
    for start, end, kind in sorted(found, key=lambda x: (x[0], -x[1])):
        if start >= last and end > start:
            out.append((start, end, kind))
            last = end
    return out


def plain(kind: str, mention: str) -> str:
    """The form that all mentions of one entity share."""
    if kind in ("phone", "card", "ssn"):
        return re.sub("[^0-9]", "", mention)
    if kind == "iban":
        return mention.replace(" ", "")
    return mention if kind in ("secret", "ip") else mention.lower()


def _numbers(key: str, kind: str, entity: str, attempt: int) -> Iterator[int]:
    """An endless keyed stream of bytes."""
    block = 0
    while True:
        yield from hmac.digest(key.encode(), f"{kind}\0{attempt}\0{block}\0{entity}".encode(), hashlib.sha256)
        block += 1


def _pick(stream: Iterator[int], n: int) -> int:
    return (next(stream) << 16 | next(stream) << 8 | next(stream)) % n


def _like(char: str, stream: Iterator[int]) -> str:
    """A character of the same kind: digit, letter of the same case and script; others as they are."""
    if char in "0123456789":
        return "0123456789"[_pick(stream, 10)]
    if "a" <= char <= "z" or "A" <= char <= "Z":
        drawn = "abcdefghijklmnopqrstuvwxyz"[_pick(stream, 26)]
        return drawn if char >= "a" else drawn.upper()
    kind = unicodedata.category(char)
    if kind[0] != "L":
        return char
    near = [c for c in map(chr, range(ord(char) & ~31, (ord(char) & ~31) + 32)) if unicodedata.category(c) == kind]
    return near[_pick(stream, len(near))]


def _script(char: str) -> str:
    return unicodedata.name(char, "").split(" ")[0].split("-")[0]


def _name_like(name: str, stream: Iterator[int]) -> str:
    """A name of letters from the block and script of each letter; marks and all else as they are."""
    out = []
    for char in name:
        kind, script, low = unicodedata.category(char), _script(char), ord(char) & ~31
        near = [c for c in map(chr, range(low, low + 32))
                if kind[0] == "L" and unicodedata.category(c) == kind and _script(c) == script and "SYMBOL" not in unicodedata.name(c)]
        out.append(near[_pick(stream, len(near))] if near else char)
    return "".join(out)


def _luhn(digits: str) -> int:
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10


def _rest_97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def surrogate(kind: str, entity: str, attempt: int, key: str) -> str:
    """The plain form that stands for an entity."""
    stream = _numbers(key, kind, entity, attempt)
    longer = max(0, attempt + 1 - LONGER)
    script = _script(entity[0]) if entity else ""
    cyrillic = script == "CYRILLIC"
    if kind == "ip":
        return ".".join(str(1 + _pick(stream, 254)) for _ in range(4))
    if (kind == "family" or kind.startswith("given")) and script not in ("LATIN", "CYRILLIC", ""):
        last = next((c for c in reversed(entity) if unicodedata.category(c)[0] == "L"), entity[-1])
        return _name_like(entity + last * longer, stream)
    if kind == "family":
        roots, ends = (ROOTS_CYRILLIC, ENDS_CYRILLIC) if cyrillic else (ROOTS, ENDS)
        inner = "".join(roots[_pick(stream, len(roots))].lower() for _ in range(1 + min(attempt, 6)))
        return roots[_pick(stream, len(roots))].lower() + inner + ends[_pick(stream, len(ends))]
    if kind.startswith("given"):
        latin, other = (MALE, MALE_CYRILLIC) if kind == "given_m" else (FEMALE, FEMALE_CYRILLIC)
        names = other if cyrillic else latin
        return "-".join(names[_pick(stream, len(names))].lower() for _ in range(1 + min(attempt, 6)))
    if kind == "card":
        body = entity[0] + "".join(_like(c, stream) for c in entity[1:-1])
        if _luhn(entity):
            return body + _like(entity[-1], stream)
        return next(body + d for d in "0123456789" if not _luhn(body + d))
    if kind == "phone":
        code = max(0, len(entity) - 10, len(entity) - len(entity.lstrip("0")))
        return entity[:code] + "".join(_like(c, stream) for c in entity[code:] + "0" * longer)
    if kind == "iban":
        body = "".join(_like(c, stream) for c in entity[4:])
        if _rest_97(entity) != 1:
            return entity[:2] + "".join(_like(c, stream) for c in entity[2:4]) + body
        return f"{entity[:2]}{98 - _rest_97(entity[:2] + '00' + body):02d}{body}"
    if kind == "email":
        name, _, host = entity.rpartition("@")
        labels, _, top = host.rpartition(".")
        return "".join(_like(c, stream) for c in f"{name}{'a' * longer}@{labels}") + f".{top}"
    if kind == "secret" and HEXADECIMAL.fullmatch(entity):
        return "".join("0123456789abcdef"[_pick(stream, 16)] for _ in range(len(entity) + longer))
    return "".join(_like(c, stream) for c in entity + ("a" * longer if kind == "secret" else ""))


def shaped(kind: str, mention: str, drawn: str) -> str:
    """The surrogate in the format and case of a mention."""
    if kind in ("phone", "card", "ssn", "iban"):
        left = iter(drawn)
        gaps = " " if kind == "iban" else None
        return "".join((c if c == gaps else next(left)) if gaps else (next(left) if c in "0123456789" else c) for c in mention) + "".join(left)
    if kind == "family" or kind.startswith("given"):
        return drawn.upper() if mention.isupper() and len(mention) > 1 else "-".join(p.capitalize() for p in drawn.split("-"))
    if kind == "email" and len(mention) == len(drawn):
        return "".join(d.upper() if m.isupper() else d for m, d in zip(mention, drawn, strict=True))
    return drawn


def rewrite(text: str, redrawn: dict[tuple[str, str], int], key: str) -> tuple[str, int]:
    """The text with surrogates, and how many entities it held."""
    out, last, spans = [], 0, find(text)
    for start, end, kind in spans:
        mention = text[start:end]
        entity = plain(kind, mention)
        out += [text[last:start], shaped(kind, mention, surrogate(kind, entity, redrawn.get((kind, entity), 0), key))]
        last = end
    return "".join([*out, text[last:]]), len(spans)


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """(text_key, kind, entity), once for each entity of each text."""
    @F.pandas_udf("array<struct<kind:string,entity:string>>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([
            [{"kind": k, "entity": e} for k, e in sorted({(k, plain(k, t[a:b])) for a, b, k in find(t)})] if isinstance(t, str) else []
            for t in texts])

    found = docs.select(F.xxhash64(text).alias("text_key"), F.explode(of(F.col(text))).alias("_e"))
    return found.select("text_key", "_e.kind", "_e.entity")


def redrawn(mentions: DataFrame, key: str) -> DataFrame:
    """(kind, entity, attempt) of the entities whose first surrogate could not stay."""
    @F.pandas_udf("string")
    def draw(kind: pd.Series, entity: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, e, int(a), key) for k, e, a in zip(kind, entity, attempt, strict=True)])

    # given names of either gender, and all else by its kind, must stay apart from each other
    pool = F.when(F.col("kind").startswith("given"), F.lit("given")).otherwise(F.col("kind"))
    drawn = draw(F.col("kind"), F.col("entity"), F.col("attempt"))
    known = mentions.select("kind", "entity").distinct().withColumn("attempt", F.lit(0))
    now = settle(known.withColumn("drawn", drawn).withColumn("pool", pool), "surrogates")
    taken = now.select("pool", F.col("entity").alias("drawn"), F.lit(True).alias("real")).distinct()
    while True:
        first = now.groupBy("pool", "drawn").agg(F.min(F.struct(-F.col("attempt"), "kind", "entity")).alias("owner"), F.count("*").alias("n"))
        bad = first.join(taken, ["pool", "drawn"], "left").where("n > 1 or real")
        clash = settle(now.join(bad, ["pool", "drawn"]).where(
            F.col("real") | (F.struct(-F.col("attempt"), "kind", "entity") != F.col("owner"))
        ).select("kind", "entity", (F.col("attempt") + 1).alias("attempt"), "pool"), "clash")
        if clash.isEmpty():
            return now.where("attempt > 0").select("kind", "entity", "attempt")
        fine = now.join(clash, ["kind", "entity"], "left_anti")
        now = settle(fine.unionByName(clash.withColumn("drawn", drawn)), "surrogates")


def surrogates(docs: DataFrame, text: str = "text", key: str | None = None) -> DataFrame:
    """``docs`` with the column ``text`` rewritten and a column ``_pii_entities``; all else as it is.

    Null and empty texts stay; texts without entities come back unchanged. Repeated rows are
    rewritten alike, wherever they are. Without ``key`` that of the session is taken.
    """
    key = key or session_key(docs.sparkSession)
    mentions = settle(entities(docs, text), "mentions")
    again = settle(redrawn(mentions, key), "redrawn")
    lists = mentions.join(again, ["kind", "entity"]).groupBy("text_key").agg(
        F.collect_set(F.struct("kind", "entity", "attempt")).alias("_pii_redrawn")).withColumnRenamed("text_key", "_pii_text_key")
    lists = small(lists)

    @F.pandas_udf("text string, n long")
    def of(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        rows = []
        for t, again in zip(texts, lists, strict=True):
            attempts = {(r["kind"], r["entity"]): r["attempt"] for r in again} if again is not None else {}
            rows.append(rewrite(t, attempts, key) if isinstance(t, str) else (None, 0))
        return pd.DataFrame(rows, columns=["text", "n"])

    if not lists.isEmpty():
        joined = docs.join(lists, F.xxhash64(docs[text]) == F.col("_pii_text_key"), "left").drop("_pii_text_key")
    else:
        joined = docs.withColumn("_pii_redrawn", F.lit(None).cast("array<struct<kind:string,entity:string,attempt:int>>"))
    made = joined.withColumn("_pii_made", of(F.col(text), F.col("_pii_redrawn")))
    columns = [F.col("_pii_made.text").alias(c) if c == text else F.col(c) for c in docs.columns]
    return made.select(*columns, F.col("_pii_made.n").alias("_pii_entities"))


def op7_pii(spark, sf_dir: str) -> DataFrame:
    """Every document with surrogates in its text."""
    made = surrogates(documents(spark, sf_dir).select("doc_id", "text"))
    return made.select("doc_id", F.col("_pii_entities").alias("n_entities"), "text")


def with_surrogates(docs: DataFrame, key: str | None = None) -> DataFrame:
    """``docs`` with rewritten texts; ``n_chars``, if there, follows the text."""
    made = surrogates(docs, key=key).drop("_pii_entities")
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)))
    return made
