"""String helpers that stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Latin letters with marks, and what they fold to (fixed values).
ACCENTED = "àáâãäåāăąçćčďèéêëēėęěìíîïīįłñńňòóôõöøōőřśšşťțùúûüūůűýÿžźżÀÁÂÃÄÅĀĂĄÇĆČĎÈÉÊËĒĖĘĚÌÍÎÏĪĮŁÑŃŇÒÓÔÕÖØŌŐŘŚŠŞŤȚÙÚÛÜŪŮŰÝŸŽŹŻ"
PLAIN = "aaaaaaaaacccdeeeeeeeeiiiiiilnnnoooooooorsssttuuuuuuuyyzzzAAAAAAAAACCCDEEEEEEEEIIIIIILNNNOOOOOOOORSSSTTUUUUUUUYYZZZ"


def fold(c: Column) -> Column:
    """Letters without their marks."""
    return F.translate(c, ACCENTED, PLAIN)


def sub(c: Column, pattern: str, made: Callable[[Column], Column]) -> Column:
    """Replace every match of pattern by what made builds from it: regexp_replace with a function."""
    found, between = F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), F.split(c, pattern, -1)
    return F.array_join(F.zip_with(between, found, lambda x, m: F.concat(x, F.when(m.isNotNull(), made(m)).otherwise(""))), "")


def quoted(replacement: str) -> str:
    """A replacement taken as it is."""
    return replacement.replace("\\", "\\\\").replace("$", "\\$")


def java_quoted(text: str) -> str:
    """A text as a pattern that matches just it."""
    return re.sub(r"([^\w\s])", r"\\\1", text)


def either(words: Iterable[str]) -> str:
    """An alternation, longest first."""
    return "|".join(java_quoted(w) for w in sorted(words, key=lambda w: (-len(w), w)))


def upper_first(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def lower_first(c: Column) -> Column:
    return F.concat(F.lower(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def words(c: Column) -> Column:
    """Runs of other characters than white space."""
    return F.regexp_extract_all(c, F.lit(r"(?U)\S+"), F.lit(0))


def count_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"(?U)\S+"))


def clock(seconds: Column) -> Column:
    """hh:mm:ss, or mm:ss under an hour; 00:00 for null."""
    s = F.floor(F.coalesce(seconds, F.lit(0))).cast("int")
    h, m = F.floor(s / 3600).cast("int"), F.floor(s % 3600 / 60).cast("int")
    return F.when(h > 0, F.format_string("%02d:%02d:%02d", h, m, s % 60)).otherwise(F.format_string("%02d:%02d", m, s % 60))


def seconds_of(text: Column) -> Column:
    """Seconds of h:mm:ss or mm:ss; null for anything else."""
    parts = F.transform(F.split(text, ":"), lambda x: x.try_cast("int"))
    ok = text.rlike(r"^\d{1,3}(:\d{1,2}){1,2}$")
    return F.when(ok, F.aggregate(parts, F.lit(0), lambda a, x: a * 60 + x))
