"""Operator 9: personal data replaced by keyed surrogates.

Every entity (an address, a number, a name word) gets one replacement of its own type for the
whole corpus, drawn by a keyed hash from the strings of its format: digits for digits, letters
of the same script and case for letters, valid check digits where the original has them, first
names of the same gender. Replacements are checked against each other and against all entities
of the corpus; colliding ones are drawn again, so different entities stay different and equal
ones stay equal.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascadia.llm.common import arrow_rows, packed, stored, utf8_key

# Titles by gender, and first names by script and gender. Names stand for
# themselves when met in a text, and are drawn from as replacements.
TITLES = {
    "m": ("Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Господин"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Señorita", "Sra", "Doña", "Госпожа"),
    "n": ("Dr", "Prof", "Professor", "Mx"),
}
FIRST_NAMES = {
    ("latin", "f"): ("Anna", "Maria", "Mary", "Laura", "Julia", "Sofia", "Emma", "Clara", "Elena", "Marta", "Lucia", "Sarah", "Alice", "Helen", "Nora", "Irene"),
    ("latin", "m"): ("John", "Peter", "James", "Paul", "Thomas", "Martin", "Daniel", "David", "Michael", "Robert", "Carlos", "Pierre", "Hans", "Karl", "Louis", "Hugo"),
    ("cyrillic", "f"): ("Анна", "Мария", "Елена", "Ольга", "Ирина", "Татьяна", "Наталья", "Вера"),
    ("cyrillic", "m"): ("Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай", "Андрей", "Павел"),
    ("greek", "f"): ("Μαρία", "Ελένη", "Άννα", "Σοφία"),
    ("greek", "m"): ("Γιώργος", "Νίκος", "Πέτρος", "Παύλος"),
}
# First names that no text is searched for, for draws after the names above turned out to be met.
SPARE_NAMES = {
    ("latin", "f"): ("Beatrix", "Cecilia", "Dorothy", "Edith", "Flora", "Greta", "Ingrid", "Judith", "Olivia", "Phoebe", "Rebecca", "Stella", "Teresa", "Ursula", "Violet", "Wilma", "Yvonne", "Zoe", "Margot", "Bridget"),
    ("latin", "m"): ("Albert", "Bernard", "Conrad", "Edgar", "Felix", "Gustav", "Henry", "Jasper", "Leon", "Oscar", "Philip", "Ralph", "Stefan", "Theo", "Ulrich", "Victor", "Walter", "Arthur", "Benedict", "Vincent"),
    ("cyrillic", "f"): ("Галина", "Людмила", "Светлана", "Надежда", "Юлия", "Зинаида", "Лариса", "Раиса"),
    ("cyrillic", "m"): ("Борис", "Виктор", "Григорий", "Евгений", "Кирилл", "Михаил", "Олег", "Фёдор"),
    ("greek", "f"): ("Δήμητρα", "Ευγενία", "Κατερίνα", "Χριστίνα"),
    ("greek", "m"): ("Ανδρέας", "Δημήτρης", "Κώστας", "Στέφανος"),
}
ALPHABETS = {
    "latin": ("bcdfghklmnprstvz", "aeiou"),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу"),
    "greek": ("βγδζκλμνπρστ", "αεηιο"),
}

_GENDER = {name.casefold(): g for (_, g), names in FIRST_NAMES.items() for name in names}
_TITLE = {t: g for g, titles in TITLES.items() for t in titles}
_NAME = r"[^\W\d_a-zà-öø-ÿа-яα-ω](?:[^\W\d_]+|(?=[-'’]))(?:[-'’][^\W\d_]+)*"
#: A title, with its full stop, as one word of a run of capitalised words.
_TITLED = rf"(?:{'|'.join(sorted(_TITLE, key=len, reverse=True))})(?:\.(?=[ ])|(?!\w))"
#: Words that a name has at most, after its title.
NAME_WORDS = 3

PATTERNS = {
    "email": re.compile(r"[\w.+%-]*\w@\w[\w-]*(?:\.[\w-]*\w)+"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?!\w)"),
    "ip": re.compile(r"(?<![\w.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\w|\.\d)"),
    "phone": re.compile(r"(?<![\w.])(?:(?P<country>\+\d{1,3})[ .-]?)?(?P<national>\(\d{2,5}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,2}|\d{2,4}[ .-]\d{3,4}[ .-]\d{3,4})(?!\w)"),
    "phone_plus": re.compile(r"(?<![\w.])(?P<country>\+\d{1,3})[ .-]?(?P<national>\d(?:[ .-]?\d){6,11})(?!\w)"),
    "phone_plain": re.compile(r"(?<![\w.-])(?P<national>\d{3}-\d{4}|\d{10})(?![\w-]|\.\d)"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "number": re.compile(r"(?<![\w.])\d(?:\d{11,18}|\d{3}(?:[ -]\d{4}){2}[ -]\d{1,7}|\d{3}[ -]\d{6}[ -]\d{5})(?!\w)"),
    "name": re.compile(rf"(?<!\w)(?:{_TITLED}|{_NAME})(?:[ ](?:{_TITLED}|{_NAME}))*"),
}
#: Tried in this order; a span belongs to the first kind that claims it.
ORDER = ("email", "iban", "ip", "ssn", "number", "phone", "phone_plus", "phone_plain", "name")
# A name can only be where one of these words is.
_KNOWN = "|".join(sorted({*_TITLE, *(n for names in FIRST_NAMES.values() for n in names)}, key=len, reverse=True))
_NAME_HINT = re.compile(rf"(?<!\w)(?:{_KNOWN})(?!\w)")

#: Rounds of drawing; what still collides then gets a hash in brackets.
MAX_ROUNDS = 12


class Entity(NamedTuple):
    start: int
    stop: int
    kind: str
    norm: str


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdecimal())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _name_words(m: re.Match) -> Iterator[Entity]:
    """The words of all names in a run of capitalised words.

    A name begins after a title, wherever that stands in the run, or with a known first name; it
    has up to ``NAME_WORDS`` words and ends before the next title.
    """
    gender, left, begins = None, 0, False
    for w in re.finditer(r"[^ ]+", m.group()):
        at, word = m.start() + w.start(), w.group()
        if (title := word.removesuffix(".")) in _TITLE:
            gender, left, begins = _TITLE[title], NAME_WORDS, True
            continue
        known = _GENDER.get(word.casefold())
        if left == 0 and known is not None:
            gender, left, begins = None, NAME_WORDS, True
        if left:
            first = begins and known is not None
            kind = f"first_{known if gender in (None, 'n') else gender}" if first else "surname"
            yield Entity(at, at + len(word), kind, word.casefold())
            left, begins = left - 1, False


def find_entities(text: str) -> list[Entity]:
    """All entities of a text in order, without overlaps.

    Where a name has been found, its words count wherever else they stand capitalised.
    """
    taken = bytearray(len(text))
    found: list[Entity] = []

    def claim(e: Entity) -> None:
        if not any(taken[e.start : e.stop]):
            taken[e.start : e.stop] = b"\x01" * (e.stop - e.start)
            found.append(e)

    has_digits = re.search(r"\d\d", text) is not None or "." in text and re.search(r"\d\.\d", text) is not None
    for kind in ORDER:
        if kind == "email" and "@" not in text or kind == "name" and not _NAME_HINT.search(text):
            continue
        if kind not in ("email", "name") and not has_digits:
            continue
        for m in PATTERNS[kind].finditer(text):
            if kind == "name":
                for e in _name_words(m):
                    claim(e)
            elif kind.startswith("phone"):
                # The country code stays, so that a number is one entity with and without it.
                digits = _digits(m.group("national"))
                if 7 <= len(digits) <= 12:
                    claim(Entity(m.start("national"), m.end("national"), "phone", digits))
            elif kind == "number":
                claim(Entity(m.start(), m.end(), kind, _digits(m.group())))
            elif kind == "iban":
                # Printed in groups of four, it may be followed by what looks like one more.
                value = m.group()
                while " " in value and not iban_valid(value.replace(" ", "")):
                    value = value.rpartition(" ")[0]
                norm = value.replace(" ", "")
                if len(norm) >= 15 and iban_valid(norm):
                    claim(Entity(m.start(), m.start() + len(value), kind, norm))
            else:
                claim(Entity(m.start(), m.end(), kind, m.group().lower()))
    names = {e.norm: e.kind for e in found if e.kind == "surname" or e.kind.startswith("first")}
    if names:
        written = {text[e.start : e.stop] for e in found if e.norm in names}
        forms = sorted(written | {w.upper() for w in written} | {w.title() for w in written}, key=len, reverse=True)
        again = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, forms))})(?!\w)")
        for m in again.finditer(text):
            if kind := names.get(m.group().casefold()):
                claim(Entity(m.start(), m.end(), kind, m.group().casefold()))
    return sorted(found)


# Replacements


class _Stream:
    """Numbers from a keyed hash."""

    def __init__(self, secret: bytes, *parts: object):
        self.secret, self.seed, self.block, self.left = secret, "\x00".join(map(str, parts)).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.new(self.secret, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        value, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return value % n


def script(text: str) -> str:
    for c in text:
        if c.isalpha():
            name = unicodedata.name(c, "LATIN")
            return next((s for s in ("cyrillic", "greek") if name.startswith(s.upper())), "latin")
    return "latin"


def _letter(c: str, at: int, stream: _Stream) -> str:
    letters = ALPHABETS[script(c)][at % 2]
    out = letters[stream.below(len(letters))]
    return out.upper() if c.isupper() else out


def _like(text: str, stream: _Stream) -> str:
    """Digits for digits and letters of the same script and case for letters."""
    out = []
    for i, c in enumerate(text):
        if c.isdecimal():
            out.append(str(stream.below(9) + 1 if i == 0 and c != "0" else stream.below(10)))
        elif c.isalpha():
            out.append(_letter(c, i, stream))
        else:
            out.append(c)
    return "".join(out)


def draw(secret: bytes, kind: str, norm: str, attempt: int) -> str:
    """The replacement of an entity in its normal form, for one attempt."""
    if attempt >= MAX_ROUNDS:
        return f"[{kind}-{hmac.new(secret, f'{kind}:{norm}'.encode(), hashlib.sha256).hexdigest()[:16]}]"
    stream = _Stream(secret, kind, norm, attempt)
    if kind == "email":
        local, _, domain = norm.rpartition("@")
        labels = domain.split(".")
        # A domain's replacement is its own, whoever writes from it; "example" is reserved.
        host = _Stream(secret, "domain", domain)
        local = _like(local, stream) + ("" if attempt < 3 else _like("0" * (attempt - 2), stream))
        return f"{local}@{'.'.join(_like(x, host) for x in labels[:-1])}.example"
    if kind == "ip":
        return ".".join(str(1 + stream.below(254)) for _ in range(4))
    if kind == "iban":
        body = _like(norm[4:], stream)
        check = 98 - int("".join(str(int(c, 36)) for c in body.upper() + norm[:2]) + "00") % 97
        return f"{norm[:2]}{check:02d}{body.upper()}"
    if kind == "number":
        out = _like(norm, stream)
        return next(x for x in (out[:-1] + str(d) for d in range(10)) if luhn(x)) if luhn(norm) else out
    if kind.startswith("first_"):
        s, gender = script(norm), kind[-1]
        pool = FIRST_NAMES if attempt == 0 else SPARE_NAMES
        names = pool[s, gender] if gender in "fm" else pool[s, "f"] + pool[s, "m"]
        if attempt < 4:
            return names[stream.below(len(names))].casefold()
        # The lists are short: later attempts make up a name.
        c, v = ALPHABETS[s]
        out = "".join(c[stream.below(len(c))] + v[stream.below(len(v))] for _ in range(2 + (attempt - 4) // 2))
        return out if gender == "f" else out + c[stream.below(len(c))]
    if kind == "surname":
        s = script(norm)
        c, v = ALPHABETS[s]
        size = max(2, (len(norm) + 1) // 2) + attempt // 3
        out = "".join(c[stream.below(len(c))] + v[stream.below(len(v))] for _ in range(size))
        if s == "cyrillic":
            # Surnames show the gender in their ending.
            out += "ова" if norm.endswith(("а", "я")) else "ов"
        return out
    return _like(norm, stream)


def dressed(kind: str, replacement: str, original: str) -> str:
    """``replacement`` in the writing of one occurrence: its separators, brackets and case."""
    if replacement.startswith("["):
        return replacement
    if kind == "iban":
        signs = iter(replacement)
        return "".join(c if c == " " else next(signs) for c in original)
    if kind in ("phone", "number"):
        digits = iter(replacement)
        return "".join(next(digits) if c.isdecimal() else c for c in original)
    if kind == "surname" or kind.startswith("first_"):
        if original.isupper() and len(original) > 1:
            return replacement.upper()
        return "-".join(p[:1].upper() + p[1:] for p in replacement.split("-"))
    return replacement


# Spark

ENTITY = T.StructType([T.StructField("kind", T.StringType()), T.StructField("norm", T.StringType())])


def _drawn(spark: SparkSession, entities: DataFrame, secret: bytes, attempt: int) -> DataFrame:
    schema = T.StructType([*ENTITY, T.StructField("surrogate", T.StringType()), T.StructField("attempt", T.IntegerType())])

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            yield {"kind": b["kind"], "norm": b["norm"], "surrogate": [draw(secret, k, n, attempt) for k, n in zip(b["kind"], b["norm"])], "attempt": [attempt] * len(b["kind"])}

    return arrow_rows(entities.select("kind", "norm"), schema, rows)


def assign_surrogates(entities: DataFrame, secret: bytes) -> DataFrame:
    """``(kind, norm, surrogate)`` for distinct entities: no two of a kind share a surrogate, and
    none is an entity of the corpus. Of colliding ones the earliest attempt and least entity stays."""
    spark = entities.sparkSession
    group = F.regexp_replace("kind", "^first_.$", "first")
    done, open_ = None, entities
    for attempt in range(MAX_ROUNDS + 1):
        new = stored(_drawn(spark, open_, secret, attempt), "surrogates-drawn")
        pool = new if done is None else done.unionByName(new)
        first = pool.groupBy(group.alias("g"), F.col("surrogate").alias("s")).agg(F.min(F.struct("attempt", "kind", "norm")).alias("w"))
        # A name of either kind may not be a name of the corpus.
        family = F.regexp_replace("kind", "^(first_.|surname)$", "name")
        real = entities.select(family.alias("rg"), F.col("norm").alias("rs")).distinct()
        clash = new.join(first, (group == F.col("g")) & (F.col("surrogate") == F.col("s"))).join(
            real, (family == F.col("rg")) & (F.col("surrogate") == F.col("rs")), "left"
        )
        good = (F.col("w.norm") == F.col("norm")) & (F.col("w.kind") == F.col("kind")) & F.col("rs").isNull()
        judged = stored(clash.select("kind", "norm", "surrogate", "attempt", good.alias("good")), "surrogates-judged")
        won = judged.where("good").drop("good")
        done = won if done is None else done.unionByName(won)
        open_ = judged.where("NOT good").select("kind", "norm")
        if open_.isEmpty():
            break
    return done.select("kind", "norm", "surrogate")


def replace_personal_data(docs: DataFrame, secret: bytes, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with every entity of the whole text replaced; same rows and columns.

    With ``count`` a column of that name tells how many replacements a row has. Null and empty
    texts stay as they are; repeated rows are all replaced alike. A text's entities travel by a
    digest of the text, so keys may be null or repeated, and a text that many rows share is
    looked up once.
    """
    some = packed(docs, text_key=utf8_key(F.col(text)), text=F.col(text))

    found_schema = T.StructType([T.StructField("text_key", T.BinaryType()), *ENTITY])

    def detect(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            hits = [(k, kind, norm) for k, t in zip(b["text_key"], b["text"]) for kind, norm in {(e.kind, e.norm) for e in find_entities(t or "")}]
            yield {"text_key": [h[0] for h in hits], "kind": [h[1] for h in hits], "norm": [h[2] for h in hits]}

    found = stored(arrow_rows(some.select("text_key", "text"), found_schema, detect).distinct(), "entities")
    table = assign_surrogates(found.select("kind", "norm").distinct(), secret)
    # The entities of one text, which its row holds anyway.
    lists = found.join(table, ["kind", "norm"]).groupBy("text_key").agg(F.collect_list(F.struct("kind", "norm", "surrogate")).alias("surrogates"))
    joined = some.join(lists, "text_key", "left").select("row", "surrogates")
    out_schema = T.StructType([joined.schema["row"], T.StructField("n", T.LongType())])
    place = docs.columns.index(text)

    def replace(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            texts, counts = [], []
            for t, pairs in zip(pc.struct_field(b["row"], place).to_pylist(), b["surrogates"]):
                entities = find_entities(t) if pairs else []
                by = {(p["kind"], p["norm"]): p["surrogate"] for p in pairs or ()}
                out, at = [], 0
                for e in entities:
                    out += [t[at : e.start], dressed(e.kind, by[e.kind, e.norm], t[e.start : e.stop])]
                    at = e.stop
                texts.append("".join([*out, t[at:]]) if entities else t)
                counts.append(len(entities))
            fields = [pc.struct_field(b["row"], i) for i in range(b["row"].type.num_fields)]
            fields[place] = pa.array(texts, b["row"].type[place].type)
            yield {"row": pa.StructArray.from_arrays(fields, fields=list(b["row"].type)), "n": counts}

    done = arrow_rows(joined, out_schema, replace, flat=["row"])
    return done.select("row.*", *([F.col("n").alias(count)] if count else []))
