"""Personal data replaced by keyed surrogates of the same type, consistently over the corpus."""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvault.llm.frames import NO_ID, boxed, pick, stored, unboxed
from docvault.llm.line_dedup import text_name

#: Given names by gender and script; further choices have two and more parts, without end.
GIVEN = {
    ("f", "LATIN"): "anna clara elena ida julia laura maria nora paula sofia".split(),
    ("m", "LATIN"): "adam bruno david emil hugo jonas leon marco oscar simon".split(),
    ("f", "CYRILLIC"): "анна вера галина дарья елена ирина мария нина ольга софия".split(),
    ("m", "CYRILLIC"): "антон борис виктор глеб иван кирилл максим олег павел роман".split(),
}
#: Names behind a label show no gender.
GIVEN |= {("x", s): GIVEN["f", s] + GIVEN["m", s] for s in ("LATIN", "CYRILLIC")}
#: Endings of made-up family names by script and, where names show it, gender.
ENDINGS = {
    ("x", "LATIN"): ["er", "in", "ley", "mann", "ton", "well"],
    ("f", "CYRILLIC"): ["ова", "ева", "ина"],
    ("m", "CYRILLIC"): ["ов", "ев", "ин"],
    ("x", "CYRILLIC"): ["енко", "ко", "ук"],
}
SYLLABLES = {
    "LATIN": "ba be bo da de do fa fe ga ha ka ke ko la le lo ma me mo na ne pa re ro sa se ta te to wa".split(),
    "CYRILLIC": "ба бе бо ва ве га го да де до за ка ко ла ле ма ме мо на не па пе ра ро са се та те то".split(),
}
#: Letters that stand for a letter of the script; other scripts use the code points around the letter.
#: Secrets with fewer letters and digits get letters for their signs, too.
FEW_SIGNS = 6
LETTERS = {"LATIN": "abcdefghijklmnopqrstuvwxyz", "CYRILLIC": "абвгдежзиклмнопрстуфхцчшэюя", "GREEK": "αβγδεζηθικλμνξοπρστυφχψω"}
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|госпожа"
MALE = "Mr|Herr|Monsieur|Señor|Sr|господин"
#: Titles that show no gender.
LEARNED = "Dr|Prof"
#: Titles may stand in capitals, names start with one.
TITLES = {"f": f"{FEMALE}|{FEMALE.upper()}", "m": f"{MALE}|{MALE.upper()}", "x": f"{LEARNED}|{LEARNED.upper()}"}
ANY_TITLE = "|".join(TITLES.values())
CAPITAL = "(?=[A-ZÀ-ÖØ-ÞĀ-ŽА-ЯЁΑ-Ω])"
NAME = r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))+"
#: Between two words of a name; a possessive ends it, and a title begins another.
NEXT = rf"(?<!['’][sS])[ \t]+(?!(?:{ANY_TITLE})\b)"
#: A word that may be, or hold, a name found elsewhere in the document.
MENTION = re.compile(r"(?<!\w)[^\W\d_]+(?:['’-][^\W\d_]+)*(?!\w)")
STREET = "Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd"
#: Cards of 16 and 19 digits in fours, of 15 and 14 digits by their first digits.
CARD = (
    r"\d{4}(?P<sep>[ -]?)\d{4}(?P=sep)\d{4}(?P=sep)\d{4}(?:(?P=sep)\d{3})?"
    r"|3[47]\d\d(?P<sep15>[ -]?)\d{6}(?P=sep15)\d{5}|3(?:0[0-5]|[689]\d)\d(?P<sep14>[ -]?)\d{6}(?P=sep14)\d{4}"
)
#: International numbers of 7 digits or more in groups of any size, others, and ten digits as 3-3-4.
PHONE = (
    r"(?=\+(?:[ .()-]{0,2}\d){7})\+(?!\d{16})\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{1,4}){2,6}(?!\d)"
    r"|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
    r"|(?<![\w+])(?<!\d[.-])(?:1[ .-])?(?:\(\d{3}\)[ .-]?\d{3}[ .-]|\d{3}(?P<dot>[.-])\d{3}(?P=dot))\d{4}(?!\w|[.-]\d)"
)
#: Country, check digits, a group of four, then digits in groups of four as written in print, or closed up.
IBAN = (
    r"(?<![A-Za-z0-9])[A-Z]{2}\d\d(?P<gap> ?)(?:[A-Z]{4}|\d{4})(?:(?P=gap)\d{4}){2,6}(?:(?P=gap)\d{1,3})?(?![A-Za-z0-9])"
)
#: Dates with a year of the last centuries, as functions.rules looks for them.
DATE = r"(?:\d{1,2}(?P<day>[/.])\d{1,2}(?P=day)(?:1[89]|20)\d\d|(?:1[89]|20)\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01]))"
#: In this order; the first that matches at a place holds.
PATTERN = re.compile(
    r"(?P<email>[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
    r"|(?P<key>(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9]))"
    r"|(?i:password|passwd|secret|token|api_key)[ \t]*[=:][ \t]*(?P<q>[\"']?)(?P<secret>[A-Za-z0-9_+/.-]{8,})(?P=q)"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])|(?:(?<=SSN )|(?<=SSN: ))\d{3} \d{2} \d{4}(?!\d))"
    rf"|(?P<iban>{IBAN})"
    rf"|(?P<phone>{PHONE})"
    rf"|(?P<card>(?<![\dA-Za-z])(?:{CARD})(?![\dA-Za-z]))"
    rf"|(?P<date>(?<![\w/.-]){DATE}(?![\d/]|[.-]\d))"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d))"
    rf"|(?P<address>(?<![\w.,/-])\d{{1,6}}[A-Za-z]?(?:[ \t]+{CAPITAL}[^\W\d_]+){{1,3}}?[ \t]+(?:{STREET})\b)"
    rf"|(?:[Nn]ame|NAME)[ \t]*:[ \t]*(?!(?:{ANY_TITLE})\b)"
    rf"(?P<label>{CAPITAL}(?:{NAME})(?:{NEXT}{CAPITAL}(?:{NAME})(?!\w|[ \t]*:)){{1,3}})"
    rf"|(?:\b(?P<f>{TITLES['f']})|\b(?P<m>{TITLES['m']})|\b(?:{TITLES['x']}))\.?[ \t]+(?!(?:{ANY_TITLE})\b)(?P<name>{CAPITAL}(?:{NAME})(?:{NEXT}{CAPITAL}(?:{NAME}))?)"
)
#: A text without any of these holds nothing that PATTERN finds.
HINT = re.compile(rf"@|\+\d|\d{{4}}|\d\.\d|\d-\d|AKIA|[=:]|[ \t](?:{STREET})\b|\b(?:{ANY_TITLE})\b|SSN ")


def draw(secret: bytes, kind: str, value: str, attempt: int) -> Iterator[int]:
    """An endless stream of bytes that only the secret's holder can tell."""
    block = 0
    while True:
        yield from hmac.digest(secret, f"{kind}\0{value}\0{attempt}\0{block}".encode(), "sha256")
        block += 1


def script(text: str) -> str:
    letter = next((c for c in text if c.isalpha()), "a")
    return unicodedata.name(letter, "LATIN").split()[0]


def shaped(value: str, stream: Iterator[int], letters: str | None = None) -> str:
    """Letters for letters of the same script and case, digits for digits, all else as it is."""
    out = []
    for c in value:
        number = next(stream) * 256 + next(stream)
        if c.isdigit() and c.isascii():
            out.append(str(number % 10))
        elif c.isalpha():
            alphabet = letters or LETTERS.get(script(c))
            new = alphabet[number % len(alphabet)] if alphabet else around(c, number)
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def around(c: str, number: int) -> str:
    """A letter of the same category near c, for scripts without a list."""
    near = [chr(p) for p in range(ord(c) // 64 * 64, ord(c) // 64 * 64 + 64) if unicodedata.category(chr(p)) == unicodedata.category(c)]
    return near[number % len(near)]


def check_digit(digits: str) -> str:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_check(country: str, body: str) -> str:
    """The two check digits: letters read as 10 to 35, modulo 97."""
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02}"


def surrogate(secret: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The replacement of a value of a kind; each attempt gives another one.

    Kinds: email, key, secret, ssn, iban, phone, card, date, ip, address, and for names `given_f`, `given_m`,
    `family_f`, `family_m` (where the name shows the gender), `given_x`, `family_x`. Length, punctuation, case, script and what makes the type valid
    (check digit, octets, month and day, kind of street, reserved mail domain, gender) are kept.
    """
    stream = draw(secret, kind, value, attempt)
    longer = attempt // 8  # where a short form may have fewer others than the corpus has values
    if kind == "email":
        local, _, domain = value.rpartition("@")
        local += "a" * longer
        return f"{shaped(local, stream)}@{shaped(domain.split('.')[0], stream)}.example.{('com', 'net', 'org')[next(stream) % 3]}"
    if kind == "key":
        return value[:4] + shaped(value[4:] + "A" * longer, stream)
    if kind == "secret":
        if sum(c.isalnum() for c in value) < FEW_SIGNS:  # too few letters and digits to tell values apart
            value = "".join(c if c.isalnum() else "a" for c in value)
        return shaped(value + value[-1] * longer, stream, "abcdef" if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) else None)
    if kind == "ip":
        return ".".join(str(1 + next(stream) % 254) for _ in range(4)) + f":{next(stream) * 256 + next(stream)}" * (longer > 0)
    if kind == "ssn":
        return f"{1 + next(stream) % 8}{shaped(value[1:] + '0' * longer, stream)}"
    if kind == "iban":
        body = shaped(value.replace(" ", "")[4:] + "0" * longer, stream)
        closed = value[:2] + iban_check(value[:2], body) + body
        return " ".join(closed[i : i + 4] for i in range(0, len(closed), 4)) if " " in value else closed
    if kind == "phone":
        head = re.match(r"\+1(?=\D)|\+\d{1,3}|1(?=[ .-])|", value)[0]
        first = re.search(r"\d", value[len(head) :])
        at = len(head) + first.start()
        return value[:at] + str(2 + next(stream) % 8) + shaped(value[at + 1 :] + "0" * longer, stream)
    if kind == "card":
        digits = re.sub(r"\D", "", value)
        brand = 1 if len(digits) in (16, 19) else 3
        new = digits[:brand] + shaped(digits[brand:-1], stream)
        last = check_digit(new) if check_digit(digits[:-1]) == digits[-1] else str(next(stream) % 10)
        left = iter(new + last)
        return "".join(next(left) if c.isdigit() else c for c in value)
    if kind == "date":
        return other_date(value, stream, attempt)
    if kind == "address":
        number, *street, way = re.split(r"([ \t]+)", value)
        made = [w if w.isspace() else made_up("LATIN", "x", stream, attempt).capitalize() for w in street]
        return str(1 + next(stream) % 9) + shaped(number[1:], stream) + "".join(made) + way
    part, gender = kind.split("_")
    write = script(value)
    if write not in SYLLABLES:
        return shaped(value + value[-1] * longer, stream)
    if part == "given":
        pool = GIVEN[gender, write]
        names = [pool[(next(stream) * 256 + next(stream)) % len(pool)] for _ in range(1 + attempt)]
        return "-".join(names)
    return made_up(write, gender, stream, attempt)


def made_up(write: str, gender: str, stream: Iterator[int], attempt: int) -> str:
    """A family name, longer with the attempts."""
    syllables, endings = SYLLABLES[write], ENDINGS[gender, write]
    count = 2 + attempt // 4
    body = "".join(syllables[(next(stream) * 256 + next(stream)) % len(syllables)] for _ in range(count))
    return body + endings[next(stream) % len(endings)]


def other_date(value: str, stream: Iterator[int], attempt: int) -> str:
    """A date written alike; from the fourth attempt on of any year of four digits."""
    number = next(stream) * 256 + next(stream)
    year = 1930 + number % 80 if attempt < 4 else 1000 + number % 9000
    if "-" in value:
        return f"{year}-{1 + next(stream) % 12:02}-{1 + next(stream) % 28:02}"
    between = "/" if "/" in value else "."
    first, second, _ = value.split(between)
    # the month is where a number up to 12 stands, the first of two such
    limits = (28, 12) if int(first) > 12 else (12, 28) if int(second) > 12 else (12, 12)
    new = []
    for old, limit in zip((first, second), limits, strict=True):
        if len(old) == 1:
            new.append(str(1 + next(stream) % 9))
        else:
            least = 13 if limit == 28 else 1
            new.append(f"{least + next(stream) % (limit + 1 - least):02}")
    return between.join((*new, str(year)))


KINDS = ("email", "key", "secret", "ssn", "iban", "phone", "card", "date", "ip", "address", "label", "name")


def detected(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, key) of what PATTERN finds in a text, in order.

    A name with a title or a label is told apart by its words, the last as the family name.
    Keys are folded to lower case where case does not tell values apart (mail addresses and
    names).
    """
    if not HINT.search(text):
        return []
    found = []
    for m in PATTERN.finditer(text):
        group = next(k for k in KINDS if m[k])
        if group not in ("label", "name"):
            value = m[group]
            found.append((*m.span(group), group, value.lower() if group == "email" else value))
            continue
        gender = "f" if m["f"] else "m" if m["m"] else "x"
        parts = list(re.finditer(r"\S+", m[group]))
        for i, part in enumerate(parts):
            kind = "family" if i == len(parts) - 1 else "given"
            start = m.start(group) + part.start()
            name = re.sub(r"(?<=\w\w)['’][sS]$", "", part[0])
            who = gender if kind == "given" or script(name) == "CYRILLIC" else "x"
            found.append((start, start + len(name), f"{kind}_{who}", name.lower()))
    return found


def entities(text: str, known: Iterable[tuple[str, str]] = ()) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, key) of the personal data in a text, in order.

    Beside what is `detected`, each whole word with a capital that is one of the text's names,
    or of the `known` (kind, key) of its document. A name of which no gender is shown has the
    gender that the document shows elsewhere; a word that is a given and a family name is
    the latter.
    """
    found = detected(text)
    names, alike = {}, {}
    for kind, key in sorted({*known, *((k, v) for _, _, k, v in found)}):
        if "_" in kind:
            part = kind.split("_")[0]
            kind = alike.setdefault((part, key), kind)
            names.setdefault(key, kind)
    if not names:
        return found
    found = [(start, end, alike.get((kind.split("_")[0], key), kind), key) for start, end, kind, key in found]
    longest = max(len(PARTS.split(key)) for key in names)
    taken, mentions = 0, []
    for word in MENTION.finditer(text):
        while taken < len(found) and found[taken][1] <= word.start():
            taken += 1
        if taken == len(found) or found[taken][0] >= word.end():
            mentions += within(word[0], word.start(), names, longest)
    return sorted(found + mentions)


#: What parts the pieces of a word.
PARTS = re.compile("['’-]")


def within(word: str, at: int, names: dict[str, str], longest: int) -> Iterator[tuple[int, int, str, str]]:
    """The names that a word is, or that whole pieces of it are (Brown in Brown's), longest first."""
    if not PARTS.search(word):
        if word[0].isupper() and (kind := names.get(word.lower())):
            yield at, at + len(word), kind, word.lower()
        return
    bounds = [-1, *(m.start() for m in PARTS.finditer(word)), len(word)]
    piece = 0
    while piece < len(bounds) - 1:
        start = bounds[piece] + 1
        for last in range(min(piece + longest, len(bounds) - 1), piece, -1):
            key = word[start : bounds[last]].lower()
            if word[start].isupper() and key in names:
                yield at + start, at + bounds[last], names[key], key
                piece = last - 1
                break
        piece += 1


def in_case_of(new: str, old: str) -> str:
    """The replacement in the case of what it replaces."""
    if old.isupper():
        return new.upper()
    if old[:1].isupper():
        return "-".join(p[:1].upper() + p[1:] for p in new.split("-"))
    return new


def replaced(text: str, spans: list[tuple[int, int, str, str]]) -> str:
    out, at = [], 0
    for start, end, kind, new in sorted(spans):
        out += [text[at:start], in_case_of(new, text[start:end]) if "_" in kind else new]
        at = end
    return "".join(out) + text[at:]


def document(doc: Column, text: Column) -> list[Column]:
    """`doc, t1, t2`: what stands for a document; a row without an id is told by its text."""
    names = [F.when(doc.isNull(), hash_).otherwise(0).alias(n) for n, hash_ in zip(("t1", "t2"), text_name(text), strict=True)]
    return [F.coalesce(doc, F.lit(NO_ID)).alias("doc"), *names]


def find_entities(docs: DataFrame) -> DataFrame:
    """`doc, t1, t2, kind, key`: the values of each text, by document."""
    names = ["doc", "t1", "t2", "kind", "key"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (*ids, *value)
                for *ids, text in zip(*(batch.column(n).to_pylist() for n in ("doc", "t1", "t2", "text")), strict=True)
                for value in sorted({(kind, key) for _, _, kind, key in detected(text)})
            ]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    rows = pick(docs, "doc_id", "text").where("text IS NOT NULL")
    rows = rows.select(*document(F.col("doc_id"), F.col("text")), "text")
    return rows.mapInArrow(run, "doc bigint, t1 bigint, t2 bigint, kind string, key string")


def settled(values: DataFrame) -> DataFrame:
    """`kind, key, settled`: a name without a gender takes the one that the corpus shows for it.

    So a name has one surrogate by title and by label. Where both genders are shown each keeps
    its own, and a mention without gender has that of the women.
    """
    part = F.split_part("kind", F.lit("_"), F.lit(1))
    name = F.col("kind").rlike("_[fmx]$")
    shown = values.where(name & ~F.col("kind").endswith("_x")).groupBy(part.alias("part"), "key").agg(F.min("kind").alias("shown"))
    both = values.withColumn("part", part).join(shown, ["part", "key"], "left")
    return both.select("kind", "key", F.when(F.col("kind").endswith("_x"), F.coalesce("shown", "kind")).otherwise(F.col("kind")).alias("settled"))


def assign_surrogates(values: DataFrame, secret: bytes) -> DataFrame:
    """`kind, key, surrogate` for the distinct `kind, key` of a corpus; no two values share one.

    A surrogate that several values have drawn stays with the one drawn with the fewest
    attempts (the least key of these); one that is itself a value of the corpus stays with
    none. The others draw again, until all are settled. Rounds are stored.
    """

    @F.pandas_udf("string")
    def drawn(kind: pd.Series, key: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(secret, *row) for row in zip(kind, key, attempt, strict=True)], dtype=object)

    told = settled(values.select("kind", "key").distinct())
    values = told.select(F.col("settled").alias("kind"), "key").distinct()
    own = values.select(F.lower("key").alias("surrogate")).distinct().withColumn("taken", F.lit(True))
    current = values.withColumn("attempt", F.lit(0)).withColumn("surrogate", drawn("kind", "key", "attempt"))
    current = stored(current, "surrogates")
    while True:
        first = current.groupBy(F.lower("surrogate").alias("s")).agg(
            F.min(F.struct("attempt", "kind", "key")).alias("first"), F.count("key").alias("n")
        )
        clash = (
            first.join(own, first["s"] == own["surrogate"], "left")
            .where("n > 1 OR taken")
            .select("s", "first", F.coalesce("taken", F.lit(False)).alias("taken"))
        )
        if clash.isEmpty():
            drawn_for = current.select(F.col("kind").alias("settled"), "key", "surrogate")
            return told.join(drawn_for, ["settled", "key"]).select("kind", "key", "surrogate")
        mine = F.struct("attempt", "kind", "key")
        drew = current.join(clash, F.lower(current["surrogate"]) == clash["s"], "left")
        again = F.col("s").isNotNull() & (F.col("taken") | (mine != F.col("first")))
        moved = drew.select("kind", "key", (F.col("attempt") + again.cast("int")).alias("attempt"), "surrogate", again.alias("again"))
        new = F.when(F.col("again"), drawn("kind", "key", "attempt")).otherwise(F.col("surrogate"))
        current = stored(moved.select("kind", "key", "attempt", new.alias("surrogate")), "surrogates")


def replace_entities(docs: DataFrame, secret: str) -> DataFrame:
    """Replace mail addresses, keys, secrets, phone, card, account (IBAN) and social security
    numbers, dates, IP and street addresses, and names by keyed surrogates.

    Names are found behind a title or the label `Name:`; after that, each whole word with a
    capital that is such a name of the same document (all rows of a doc_id; a row without one
    is its own) is replaced too.

    The same value gets the same surrogate everywhere (coreference), different values different
    ones (distinctness, checked over all values of the corpus; case does not tell them apart).
    Without the secret nothing leads back.

    Returns the columns of `docs` with `text` changed, plus `n_entities` (mentions) and `kinds`
    (which); columns of these names are replaced. Null texts stay null, with 0 and
    no kinds, as do texts without personal data stay as they are. Rows without doc_id are
    treated alike. No rows give no rows. Values that differ by case only (other than mail
    addresses and names) are different values.

    The values of a document are exchanged once for each value and once for the document,
    texts once by document; mentions are looked for again inside the row. A value or a
    document with very many rows is split by Spark in the joins; the values of one document
    meet in one task.
    """
    names = docs.columns
    found = stored(find_entities(docs), "entities")
    mapping = stored(assign_surrogates(found, secret.encode()), "mapping")
    values = (
        found.distinct()
        .join(mapping, ["kind", "key"])
        .groupBy("doc", "t1", "t2")
        .agg(F.collect_list(F.struct("kind", "key", "surrogate")).alias("values"))
    )
    rows = boxed(docs, "row", "doc_id", "text").select(*document(F.col("doc_id"), F.col("text")), "text", "row")

    @F.pandas_udf("text string, n_entities bigint, kinds string")
    def rewritten(texts: pd.Series, values: pd.Series) -> pd.DataFrame:
        out = []
        for text, own in zip(texts, values, strict=True):
            if text is None or own is None or not len(own):
                out.append((text, 0, ""))
                continue
            new = {(v["kind"], v["key"]): v["surrogate"] for v in own}
            spans = [(start, end, kind, new[kind, key]) for start, end, kind, key in entities(text, new)]
            out.append((replaced(text, spans), len(spans), ",".join(sorted({kind for _, _, kind, _ in spans}))))
        return pd.DataFrame(out, columns=["text", "n_entities", "kinds"])

    both = rows.join(values, ["doc", "t1", "t2"], "left").select("row", rewritten("text", "values").alias("new"))
    return unboxed(both, "row", names, **{n: F.col(f"new.{n}") for n in ("text", "n_entities", "kinds")})
