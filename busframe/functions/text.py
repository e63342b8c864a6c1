"""Text and array helpers as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def attribute_code(line: Column) -> Column:
    """The code of a recorder attribute `CODE:value;`."""
    return F.regexp_extract(line, r"^([0-9A-Za-z\\-]+):(.*);$", 1)


def attribute_value(line: Column) -> Column:
    return F.regexp_extract(line, r"^([0-9A-Za-z\\-]+):(.*);$", 2)


def code_pattern(template: str) -> str:
    r"""Pattern of a code template: `R-x\TK1-n` matches codes with numbers for its single lower-case letters, each a group."""
    parts = re.split(r"(?<=-)([a-z])(?![0-9A-Za-z])", template)
    return "^" + "".join("([0-9]+)" if i % 2 else re.escape(p).replace("/", r"\/") for i, p in enumerate(parts)) + "$"


def percent_encode(text: Column) -> Column:
    """All but letters, digits and -_.~ as %xx in lower case; null if a character isn't ASCII."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    coded = F.transform(chars, lambda c: F.when(c.rlike(r"^[A-Za-z0-9\-_.~]$"), c).otherwise(F.concat(F.lit("%"), F.lower(F.lpad(F.hex(F.ascii(c)), 2, "0")))))
    return F.when(is_ascii(text), F.array_join(coded, ""))


def is_integer(text: Column) -> Column:
    return text.rlike(r"^[+-]?[0-9]+\z")


def is_number(text: Column) -> Column:
    return text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z")


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def is_valid_utf8(data: Column) -> Column:
    """Whether bytes are well-formed UTF-8; false if there are none."""
    return (F.octet_length(data) > 0) & F.is_valid_utf8(data.cast("string"))


def uid(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def padded(words: Column, size: int) -> Column:
    """A list at its fixed length, zeros at the end."""
    return F.concat(F.slice(words, 1, size), F.when(F.size(words) < size, F.array_repeat(F.lit(0), size - F.size(words))).otherwise(F.array().cast("array<int>")))
