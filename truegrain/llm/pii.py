"""Personal data: detected entities give way to keyed, type-consistent surrogates (operator 7)."""

from __future__ import annotations

import re
import sys
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.llm.common import bitmap, in_bitmap
from truegrain.session import materialize

OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: Kinds that consist of digits and their separators; tried in this order where such a stretch begins.
NUMBERS = {
    "ip": re.compile(rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?!\w|\.\d)"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "card": re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])"),
    "phone": re.compile(r"(?<![\w.])(?:\+\d{8,15}|(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4})(?![\w-])"),
}
STRETCH = re.compile(r"[+(0-9][0-9 ().+-]{6,}")
#: Kinds with letters. They begin with a set of characters, so a search passes over the rest of a text quickly.
EMAIL = re.compile(r"@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IBAN = re.compile(r"[A-Z](?<!\w.)[A-Z]\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b")
HEX = re.compile(r"(?<![0-9A-Za-z])([0-9a-fA-F]{16,64})\b")
AWS = re.compile(r"AKIA[0-9A-Z]{16}\b")
DIGIT = re.compile(r"[0-9]")
RUN = re.compile(r"\w+")
#: All capital letters of Unicode, as ranges of a character class.
CAPITAL = "".join(f"{chr(run[0])}-{chr(run[-1])}" for _, g in groupby(enumerate(i for i in range(sys.maxunicode + 1) if chr(i).isupper() or chr(i).istitle()), lambda x: x[1] - x[0]) for run in [[c for _, c in g]])
#: A name ends in a letter and leaves a possessive 's behind.
NAME = rf"[{CAPITAL}][\w'’-]*[^\W\d_](?<!['’][sS])"
#: Two words with capitals in a row, without which there is no name to look for.
CAPITALS = re.compile(rf"[{CAPITAL}][\w'’-]*\.? [{CAPITAL}]")
TITLES = {
    "m": ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Господин"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"),
}
TITLED = re.compile(r"\b(" + "|".join(t for g in TITLES.values() for t in g) + rf")\.? ({NAME})(?: ({NAME}))?")
#: Given names of either gender and script, both to find names by and to draw surrogates from.
GIVEN = {
    ("m", "latin"): "James Robert John Michael David William Thomas Peter Paul Daniel Martin Andreas Stefan Pierre Antoine Carlos Miguel Javier Pablo Lukas".split(),
    ("f", "latin"): "Mary Patricia Jennifer Linda Susan Sarah Karen Laura Anna Julia Katrin Sabine Claire Camille Sophie Carmen Lucia Elena Marta Emma".split(),
    ("m", "cyrillic"): "Иван Пётр Алексей Дмитрий Николай Сергей Андрей Михаил".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана".split(),
}
GENDER = {n: g for (g, _), names in GIVEN.items() for n in names}
NAMED = re.compile(r"\b(" + "|".join(GENDER) + rf") ({NAME})")
SYLLABLES = {"latin": "ba ber cor dan del far gol har kel lan mar nor pel ras sol tam ver win yor zan".split(), "cyrillic": "ба вер гор дан зем кар лаз мир нов пол рос сем тих фед шан яр".split()}


def script_of(word: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in word) else "latin"


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities of a text, in order, without overlap. Names are given_m, given_f and surname;
    a name found once is found again where it stands alone, so that all mentions change alike."""
    found = []
    if "@" in text:
        for m in EMAIL.finditer(text):
            local = m.start()
            while local and text[local - 1] in LOCAL:
                local -= 1
            if local < m.start():
                found.append((local, -m.end(), 0, "email"))
    if DIGIT.search(text):
        for stretch in STRETCH.finditer(text):
            for at in range(stretch.start(), stretch.end()):
                if text[at] in "+(0123456789" and (at == stretch.start() or not text[at - 1].isdigit()):
                    for order, (kind, pattern) in enumerate(NUMBERS.items(), 1):
                        m = pattern.match(text, at)
                        if m:
                            found.append((at, -m.end(), order, kind))
        found += [(m.start(), -m.end(), 10, "iban") for m in IBAN.finditer(text)]
        found += [(m.start(1), -m.end(), 11, "secret") for m in HEX.finditer(text) if not m[1].isdigit() and not m[1].isalpha()]
        found += [(m.start(), -m.end(), 9, "secret") for m in AWS.finditer(text)]
    if not CAPITALS.search(text):
        return _apart(found)
    names: dict[str, tuple[int, str]] = {}
    for m in TITLED.finditer(text):
        gender = "m" if m[1] in TITLES["m"] else "f"
        if m[3]:
            found.append((m.start(2), -m.end(2), 50, f"given_{gender}"))
            names.setdefault(m[2], (53, f"given_{gender}"))
        last = 3 if m[3] else 2
        found.append((m.start(last), -m.end(last), 50, "surname"))
        names[m[last]] = (52, "surname")
    for m in NAMED.finditer(text):
        found += [(m.start(1), -m.end(1), 51, f"given_{GENDER[m[1]]}"), (m.start(2), -m.end(2), 51, "surname")]
        names.setdefault(m[1], (53, f"given_{GENDER[m[1]]}"))
        names[m[2]] = (52, "surname")
    if names:
        # by their first run of word characters, so that a text with many names is still read once
        by_head: dict[str, list[str]] = {}
        for name in names:
            by_head.setdefault(RUN.match(name)[0], []).append(name)
        for m in RUN.finditer(text):
            for name in by_head.get(m[0], ()):
                end = m.start() + len(name)
                if text.startswith(name, m.start()) and not RUN.match(text, end):
                    order, kind = names[name]
                    found.append((m.start(), -end, order, kind))
    return _apart(found)


def _apart(found: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """Of overlapping finds (start, -end, order, kind) the one that begins first, then the longer, then the lower order."""
    out, at = [], 0
    for start, end, _, kind in sorted(found):
        if start >= at:
            out.append((start, -end, kind))
            at = -end
    return out


def canonical(kind: str, value: str) -> str:
    """What counts as the same entity: digits of numbers, lower case of addresses and names, a secret as it stands."""
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    return value if kind == "secret" else value.lower()


def _stream(secret: bytes, *parts: str):
    """Endless keyed bytes for an entity."""
    import hashlib
    import hmac

    name, block = "\x1f".join(parts).encode("utf-8", "surrogatepass"), 0
    while True:
        yield from hmac.new(secret, block.to_bytes(4, "big") + name, hashlib.sha256).digest()
        block += 1


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def surrogate(secret: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The replacement of a canonical value, canonical itself; it depends on key, kind, value and attempt only.

    Lengths and kinds of characters stay: country codes, networks of cards with their check digit,
    top-level domains, hexadecimal secrets. Names keep gender and script; the first attempts draw
    from lists, later ones build names, so there is no end of them.
    """
    draw = _stream(secret, kind, value, str(attempt))

    def pick(options: str | list) -> str:
        n = (next(draw) << 16) + (next(draw) << 8) + next(draw)
        return options[n % len(options)]

    if kind == "ip":
        return ".".join(pick([str(i) for i in range(1, 255)]) for _ in range(4))
    if kind.startswith("given") or kind == "surname":
        script, gender = script_of(value), kind[-1]
        female_ending = script == "cyrillic" and kind == "surname" and value.endswith(("ова", "ева", "ина", "ая"))
        if kind != "surname" and attempt < 4:
            return pick(GIVEN[gender, script]).lower()
        name = "".join(pick(SYLLABLES[script]) for _ in range(2 + min(attempt, 12) // 2))
        if kind == "surname":
            return name + {("latin", False): pick(["son", "man", "er", "ez", "et", "is"]), ("cyrillic", True): "ова", ("cyrillic", False): "ов"}[script, female_ending]
        return name + {("latin", "f"): "a", ("latin", "m"): "o", ("cyrillic", "f"): "а", ("cyrillic", "m"): "ий"}[script, gender]
    kept = {"phone": max(0, len(value) - 10), "card": 1, "iban": 2}.get(kind, 4 if value.startswith("AKIA") else 0)
    stop = value.rindex(".") if kind == "email" else len(value)
    hexadecimal = kind == "secret" and not value.startswith("AKIA")
    out = []
    for i, c in enumerate(value):
        if not kept <= i < stop or not c.isalnum():
            out.append(c)
        elif hexadecimal:
            out.append(pick("0123456789ABCDEF" if c.isupper() else "0123456789abcdef"))
        elif c.isdigit():
            out.append(pick("23456789" if kind == "phone" and i in (kept, kept + 3) else "0123456789"))
        else:
            out.append(pick("abcdefghijklmnopqrstuvwxyz") if c.islower() else pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    made = "".join(out)
    if kind == "card" and luhn(value):
        made = next(made[:-1] + d for d in "0123456789" if luhn(made[:-1] + d))
    return made


def rendered(kind: str, original: str, made: str) -> str:
    """The surrogate in the form of the original: its separators, and its case."""
    if kind.startswith("given") or kind == "surname":
        return made.upper() if original.isupper() and len(original) > 1 else made.title() if original[0].isupper() else made
    if kind == "ip":
        return made
    letters = iter([c for c in made if c.isalnum()])
    out = [next(letters) if c.isalnum() else c for c in original]
    return "".join(m.upper() if o.isupper() else m for o, m in zip(original, out, strict=True))


def rewrite(secret: bytes, text: str, attempts: dict) -> tuple[str, list[dict]]:
    """The text with surrogates, and (kind, start, length, surrogate) of each entity, in places of the original."""
    out, entities, at = [], [], 0
    for start, end, kind in find(text):
        value = canonical(kind, text[start:end])
        new = rendered(kind, text[start:end], surrogate(secret, kind, value, attempts.get((kind, value), 0)))
        out += [text[at:start], new]
        entities.append({"kind": kind, "start": start, "length": end - start, "surrogate": new})
        at = end
    return "".join([*out, text[at:]]), entities


def settled(entities: DataFrame, secret: bytes) -> DataFrame:
    """(kind, value, attempt) of the entities whose first surrogate will not do, from distinct (kind, value).

    A surrogate must differ from every real value of its kind and from every other entity's
    surrogate. Of those that share one the least value keeps it; the others draw again, until no
    surrogate meets another. Each round is written; after the first, few entities are left to move.
    """

    @F.arrow_udf("string")
    def made(kinds, values, attempts):
        import pyarrow as pa

        return pa.array([surrogate(secret, k, v, a) for k, v, a in zip(kinds.to_pylist(), values.to_pylist(), attempts.to_pylist(), strict=True)], pa.string())

    state = materialize(entities.withColumn("attempt", F.lit(0)).withColumn("made", made("kind", "value", "attempt")), "surrogates")
    while True:
        shared = state.groupBy("kind", "made").agg(F.count("*").alias("n"), F.min("value").alias("least")).filter("n > 1").select("kind", "made", "least")
        real = state.select("kind", F.col("value").alias("made")).join(state.select("kind", "made").distinct(), ["kind", "made"], "left_semi").withColumn("least", F.lit(None).cast("string"))
        clashes = materialize(shared.unionByName(real).groupBy("kind", "made").agg(F.min("least").alias("least"), F.max(F.col("least").isNull()).alias("none")), "clashes")
        if clashes.isEmpty():
            return state.filter("attempt > 0").select("kind", "value", "attempt")
        moves = F.col("none") | (F.col("value") != F.col("least"))
        met = state.join(clashes, ["kind", "made"], "left").withColumn("attempt", F.col("attempt") + F.when(F.coalesce(moves, F.lit(False)), 1).otherwise(0))
        state = materialize(met.select("kind", "value", "attempt").withColumn("made", made("kind", "value", "attempt")), "surrogates")


def replace_personal_data(docs: DataFrame, secret: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, entities) of every document: text with surrogates, entities as (kind, start, length, surrogate).

    The same entity has the same surrogate in all documents, different entities different ones. Null
    texts stay null and have no entities. The mapping needs no table but for the few entities that
    draw again: documents that hold one of those look it up, the others are rewritten where they are read.
    """
    kind_of_key = docs.schema[key].dataType.simpleString()

    def detect(batches):
        import pyarrow as pa

        for batch in batches:
            at, kinds, values = [], [], []
            for i, value in enumerate(batch.column(1)):
                body = value.as_py() or ""
                for kind, name in sorted({(k, canonical(k, body[s:e])) for s, e, k in find(body)}):
                    at.append(i)
                    kinds.append(kind)
                    values.append(name)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(kinds, pa.string()), pa.array(values, pa.string())], names=["_row", "kind", "value"])

    def write(batches):
        import pyarrow as pa

        kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32()), ("surrogate", pa.string())]))
        for batch in batches:
            texts, entities = [], []
            for value, other in zip(batch.column(1), batch.column(2), strict=True):
                attempts = {(o["kind"], o["value"]): o["attempt"] for o in other.as_py() or []}
                new, spans = rewrite(secret, value.as_py(), attempts) if value.is_valid else (None, [])
                texts.append(new)
                entities.append(spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(entities, kinds)], names=[key, text, "entities"])

    named = docs.select(F.col(key), F.col(text), F.xxhash64(key, text).alias("_row"))
    spans = materialize(named.select("_row", text).mapInArrow(detect, "_row long, kind string, value string"), "spans")
    again = materialize(settled(spans.select("kind", "value").distinct(), secret), "again")
    none = F.lit(None).cast("array<struct<kind:string,value:string,attempt:int>>")
    asked = named.select(key, text, none.alias("again"))
    if not again.isEmpty():
        touched = spans.join(again, ["kind", "value"]).groupBy("_row").agg(F.collect_set(F.struct("kind", "value", "attempt")).alias("again"))
        touched = materialize(touched, "touched")
        flagged = in_bitmap(named, "_row", materialize(bitmap(touched.select("_row"), "_row"), "bitmap"))
        asked = flagged.filter("not _hit").select(key, text, none.alias("again")).unionByName(flagged.filter("_hit").join(touched, "_row", "left").select(key, text, "again"))
    return asked.mapInArrow(write, f"`{key}` {kind_of_key}, `{text}` string, entities array<struct<kind:string,start:int,length:int,surrogate:string>>")
