"""Built-in patterns that fill the seven categories without an outside call.

They cover written shapes only: labelled names, street numbers, digit groups. Text that
needs understanding goes through a model (operators.classify.classify_with).
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from docvault.functions.classification import make_classification, no_strings

SECRET = 'token = "[0-9a-f]+"'
NAME = "[Nn]ame: ([A-Z][a-z]+ [A-Z][a-z]+)"
EMAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"
PHONE = "[+]1[ -]?[(]?[0-9]{3}[)]?[ -][0-9]{3}-[0-9]{4}"
SSN = "[0-9]{3}-[0-9]{2}-[0-9]{4}"
ADDRESS = "[0-9]+ [A-Z][a-z]+ (?:Street|St|Avenue|Ave|Road|Rd)"
BIRTH_DATE = "[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2}"
CARD = "[0-9]{16}"
IP = "[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}"


def from_run_start(chars: str, pattern: str) -> str:
    """A pattern whose match may only begin at the start of a run of chars, or right behind
    the last match.

    Any later start in the same run would fail the same way, so the matches stay the same
    and a long run without a match costs one scan instead of one per character.
    """
    return f"(?=[{chars}])(?:(?<![{chars}])|\\G){pattern}"


def contains_any(text: Column, literals: list[str]) -> Column:
    """A cheap test on the raw bytes, for skipping patterns that cannot match."""
    return reduce(or_, [text.contains(one) for one in literals])


def has_digit(text: Column) -> Column:
    return contains_any(text, list("0123456789"))


def matches(text: Column, pattern: str, possible: Column, group: int = 0) -> Column:
    """All matches of a pattern in texts where they are possible at all."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return F.when(possible, found).otherwise(no_strings())


def without_secrets(text: Column) -> Column:
    """Text with secret tokens taken out, so that their digits match nothing else."""
    return F.when(text.contains('token = "'), F.regexp_replace(text, SECRET, "")).otherwise(text)


def typed(kind: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(kind).alias("type"), v.alias("value")))


def classify_text(text: Column, plain: Column, digits: Column) -> Column:
    """Classification of a text; plain is the text without secrets, digits whether it has any."""
    street = contains_any(plain, [" St", " Ave", " Ro", " Rd"])
    lists = {
        "names": matches(plain, NAME, plain.contains("ame: "), group=1),
        "emails": matches(plain, from_run_start("A-Za-z0-9._%+-", EMAIL), plain.contains("@")),
        "phones": matches(plain, PHONE, digits & plain.contains("+1")),
        "ssns": matches(plain, SSN, digits & plain.contains("-")),
        "addresses": matches(plain, from_run_start("0-9", ADDRESS), digits & street),
        "dates_of_birth": matches(
            plain, f"(?=[0-9])(?:{BIRTH_DATE})", digits & contains_any(plain, ["/", "-"])
        ),
    }
    other_pii = F.concat(
        typed("CARD", matches(plain, CARD, digits)),
        typed("IP", matches(plain, IP, digits)),
        typed("SECRET", matches(text, SECRET, text.contains('token = "'))),
    )
    return make_classification(lists, other_pii, F.lit(False))
