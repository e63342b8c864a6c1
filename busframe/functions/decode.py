"""Engineering units from bus words, as column expressions.

A 1553 element lies in an array<int> of unsigned 16-bit words, from `offset` on; a 429 element in one unsigned 32-bit long.
Bits are numbered from 1, the most significant. All results are double; `typed` gives the column its declared type.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _word(words: Column, offset: int | Column, i: int = 0) -> Column:
    return F.get(words, offset + i if isinstance(offset, Column) else F.lit(offset + i)).cast("long")


def bit_count(k: int, msb: int, lsb: int) -> int:
    """Bits of a field over k words that starts at bit msb of the first and ends at bit lsb of the last."""
    return lsb - msb + 1 if k == 1 else 17 - msb + lsb + 16 * (k - 2)


#: Bits of a field that a long, and a decimal, holds; wider ones are summed as doubles.
LONG_BITS, DECIMAL_BITS = 62, 120


def raw_field(words: Column, offset: int, k: int, msb: int, lsb: int) -> Column:
    """The field as an unsigned number: long up to 62 bits, decimal up to 120, double beyond. Null where a word is missing."""
    n = bit_count(k, msb, lsb)
    if k == 1:
        return F.shiftright(_word(words, offset), 16 - lsb).bitwiseAND(F.lit((1 << n) - 1))
    parts = [(_word(words, offset).bitwiseAND(F.lit((1 << (17 - msb)) - 1)), 0)]
    parts += [(_word(words, offset, i), 16) for i in range(1, k - 1)]
    parts += [(F.shiftright(_word(words, offset, k - 1), 16 - lsb), lsb)]
    kind = "long" if n <= LONG_BITS else "decimal(38,0)" if n <= DECIMAL_BITS else "double"
    total = parts[0][0].cast(kind)
    for value, bits in parts[1:]:
        factor = F.lit(1 << bits)
        total = (total * (factor.cast("decimal(6,0)") if kind.startswith("dec") else factor) + value).cast(kind)
    return total


def raw_field32(word: Column, msb: int, lsb: int) -> Column:
    """Bits msb to lsb of an unsigned 32-bit word, whichever halves they lie in."""
    return F.shiftright(word.cast("long"), 32 - lsb).bitwiseAND(F.lit((1 << (lsb - msb + 1)) - 1))


def _scale(msb_val: float, bits: int) -> float:
    return msb_val / 2.0**bits if msb_val else 1.0


def unsigned(raw: Column, n: int, msb_val: float = 0.0) -> Column:
    """msb_val is the weight of the first bit; 0 stands for no scaling."""
    return raw.cast("double") * F.lit(_scale(msb_val, n - 1))


def flag(raw: Column) -> Column:
    return raw != 0


def twos_complement(raw: Column, n: int, msb_val: float = 0.0) -> Column:
    """msb_val is the weight of the bit after the sign."""
    half = F.lit(2 ** (n - 1)) if n <= LONG_BITS else F.lit(Decimal(2 ** (n - 1))) if n <= DECIMAL_BITS else F.lit(2.0 ** (n - 1))
    signed = raw.cast("double") - F.when(raw >= half, F.lit(2.0**n)).otherwise(F.lit(0.0))
    return signed * F.lit(_scale(msb_val, n - 2))


def sign_magnitude(raw: Column, n: int, msb_val: float = 0.0) -> Column:
    magnitude = raw.bitwiseAND(F.lit((1 << (n - 1)) - 1)).cast("double") * F.lit(_scale(msb_val, n - 2))
    return F.when(raw.bitwiseAND(F.lit(1 << (n - 1))) != 0, -magnitude).otherwise(magnitude)


def bcd(raw: Column, n: int, partial: int = 0) -> Column:
    """Four-bit decimal digits from the first bit. Bits left over are dropped (0), a short last digit (1) or a short first one (-1)."""
    rest = n % 4
    widths = [4] * (n // 4)
    if rest and partial > 0:
        widths.append(rest)
    elif rest and partial < 0:
        widths.insert(0, rest)
    at, digits = n, []
    for i, w in enumerate(widths):
        at -= w
        digits.append(F.shiftright(raw, at).bitwiseAND(F.lit((1 << w) - 1)).cast("double") * F.lit(10.0 ** (len(widths) - 1 - i)))
    return reduce(lambda a, b: a + b, digits, F.lit(0.0))


def ssm_sign(ssm: Column) -> Column:
    """Sign of a 429 BCD value: minus for 3."""
    return F.when(ssm == 3, F.lit(-1)).otherwise(F.lit(1))


def ascii_code(raw: Column) -> Column:
    """The last eight bits as a signed number."""
    low = F.pmod(raw, F.lit(256)).cast("int")
    return F.when(low > 127, low - 256).otherwise(low)


def _two(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def _add(*terms: Column) -> Column:
    return reduce(lambda a, b: a + b, terms)


def _excess_128(sign: Column, exponent: Column, terms: list[Column], zero: Column) -> Column:
    """Shared layout of the GPS floats: exponent 0 means no leading one half, and with a sign no number at all."""
    value = F.when(sign == 1, F.lit(-1.0)).otherwise(F.lit(1.0)) * _two(exponent - 128) * _add(F.lit(0.5), *terms)
    return F.when(zero, F.lit(0.0)).when((exponent == 0) & (sign == 0), _add(*terms)).when(exponent == 0, F.lit(float("nan"))).otherwise(value)


def float32_gps(words: Column, offset: int) -> Column:
    w = [_word(words, offset, i) for i in range(2)]
    fraction = (w[0].bitwiseAND(F.lit(127)) * 65536 + w[1]).cast("double") / F.lit(2.0**24)
    return _excess_128(F.shiftright(w[0], 15), F.shiftright(w[0], 7).bitwiseAND(F.lit(255)), [fraction], _add(*w) == 0)


def float64_gps(words: Column, offset: int) -> Column:
    w = [_word(words, offset, i) for i in range(4)]
    terms = [x.cast("double") / F.lit(2.0**p) for x, p in zip([w[0].bitwiseAND(F.lit(127)), *w[1:]], (8, 24, 40, 56), strict=True)]
    return _excess_128(F.shiftright(w[0], 15), F.shiftright(w[0], 7).bitwiseAND(F.lit(255)), terms, _add(*w) == 0)


def caps(words: Column, offset: int) -> Column:
    """48 bits in three words, the exponent in the low byte of the first and the sign in the last."""
    w = [_word(words, offset, i) for i in range(3)]
    terms = [(w[2].bitwiseAND(F.lit(32767)) * F.lit(1 << 24) + w[1] * 256 + F.shiftright(w[0], 8)).cast("double") / F.lit(2.0**40)]
    return _excess_128(F.shiftright(w[2], 15), w[0].bitwiseAND(F.lit(255)), terms, _add(*w) == 0)


def float16(words: Column, offset: int) -> Column:
    """Sign, 11 bits of mantissa, 4 bits of exponent to the base 16."""
    w = _word(words, offset)
    value = F.shiftright(w, 4).bitwiseAND(F.lit(2047)).cast("double") * F.pow(F.lit(16.0), w.bitwiseAND(F.lit(15)).cast("double"))
    return F.when(w == 0, F.lit(0.0)).when(w >= 32768, -value).otherwise(value)


def _ieee(sign: Column, exponent: Column, fraction: Column, bias: int, bits: int, special: int) -> Column:
    size = F.when(exponent == 0, fraction / F.lit(2.0**bits) * F.lit(2.0 ** (1 - bias))).otherwise((1 + fraction / F.lit(2.0**bits)) * _two(exponent - bias))
    size = F.when(exponent == special, F.when(fraction == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))).otherwise(size)
    return F.when(sign == 1, -size).otherwise(size)


def float32_ieee(words: Column, offset: int) -> Column:
    w = [_word(words, offset, i) for i in range(2)]
    return _ieee(F.shiftright(w[0], 15), F.shiftright(w[0], 7).bitwiseAND(F.lit(255)), (w[0].bitwiseAND(F.lit(127)) * 65536 + w[1]).cast("double"), 127, 23, 255)


def float64_ieee(words: Column, offset: int) -> Column:
    w = [_word(words, offset, i) for i in range(4)]
    fraction = (w[0].bitwiseAND(F.lit(15)) * F.lit(1 << 48) + w[1] * F.lit(1 << 32) + w[2] * 65536 + w[3]).cast("double")
    return _ieee(F.shiftright(w[0], 15), F.shiftright(w[0], 4).bitwiseAND(F.lit(2047)), fraction, 1023, 52, 2047)


def float32_1750(words: Column, offset: int) -> Column:
    """24-bit two's complement mantissa, 8-bit two's complement exponent."""
    w = [_word(words, offset, i) for i in range(2)]
    mantissa = (w[0].bitwiseAND(F.lit(32767)) * 256 + F.shiftright(w[1], 8)).cast("double") / F.lit(2.0**23) - F.when(w[0] >= 32768, F.lit(1.0)).otherwise(F.lit(0.0))
    exponent = w[1].bitwiseAND(F.lit(255))
    exponent = exponent - F.when(exponent >= 128, 256).otherwise(0)
    return F.when(_add(*w) == 0, F.lit(0.0)).otherwise(_two(exponent) * mantissa)


#: Words that a word-level encoding takes.
WORD_COUNTS = {"SIGNED16": 1, "UNSIGNED16": 1, "SIGNED32": 2, "UNSIGNED32": 2, "FLOAT16": 1, "FLOAT32_GPS": 2, "FLOAT32_IEEE": 2, "FLOAT32_1750": 2, "CAPS": 3, "FLOAT64_GPS": 4, "FLOAT64_IEEE": 4}
_FLOATS = {"FLOAT16": float16, "FLOAT32_GPS": float32_gps, "FLOAT32_IEEE": float32_ieee, "FLOAT32_1750": float32_1750, "CAPS": caps, "FLOAT64_GPS": float64_gps, "FLOAT64_IEEE": float64_ieee}
BIT_LEVEL = ("UNSIGNEDBITS", "SIGNEDBITS", "ASCII", "BCD", "SIGNMAG")


def output_type(schema: str, n: int) -> str:
    """Column type of an element: by encoding and, for bit fields, their length."""
    if schema == "ASCII":
        return "tinyint"
    if schema == "UNSIGNEDBITS" and n == 1:
        return "boolean"
    if schema in BIT_LEVEL:
        return "float" if n < 25 else "double"
    return "float" if schema in ("SIGNED16", "UNSIGNED16", "FLOAT16") or schema.startswith("FLOAT32") else "double"


def _bits(schema: str, raw: Column, n: int, msb_val: float, partial: int, sign: Column | None) -> Column:
    if schema == "UNSIGNEDBITS":
        return flag(raw) if n == 1 else unsigned(raw, n, msb_val)
    if schema == "SIGNEDBITS":
        return twos_complement(raw, n, msb_val)
    if schema == "ASCII":
        return ascii_code(raw)
    if schema == "SIGNMAG":
        return sign_magnitude(raw, n, msb_val)
    if schema != "BCD":
        raise ValueError(f"unknown encoding {schema}")
    value = bcd(raw, n, partial)
    return value if sign is None else value * sign


def decode(schema: str, words: Column, offset: int, k: int = 1, msb: int = 1, lsb: int = 16, msb_val: float = 0.0, partial: int = 0) -> Column:
    """A 1553 element of any encoding, with its declared type."""
    if schema in BIT_LEVEL:
        if schema == "ASCII" and k > 2:  # its eight bits lie in the last two words
            offset, k, msb = offset + k - 2, 2, 1
        n = bit_count(k, msb, lsb)
        return _bits(schema, raw_field(words, offset, k, msb, lsb), n, msb_val, partial, None).cast(output_type(schema, n))
    if WORD_COUNTS[schema] != k:
        raise ValueError(f"{schema} takes {WORD_COUNTS[schema]} words, not {k}")
    if schema in _FLOATS:
        value = _FLOATS[schema](words, offset)
    else:
        value = (unsigned if schema.startswith("UNSIGNED") else twos_complement)(raw_field(words, offset, k, 1, 16), 16 * k, msb_val)
    return value.cast(output_type(schema, 16 * k))


def decode32(schema: str, word: Column, msb: int, lsb: int, msb_val: float = 0.0, partial: int = -1, sign: Column | None = None) -> Column:
    """A 429 element, bits msb to lsb of a 32-bit word; sign multiplies BCD values."""
    n = lsb - msb + 1
    return _bits(schema, raw_field32(word, msb, lsb), n, msb_val, partial, sign).cast(output_type(schema, n))


def _power(x: Column) -> Column:
    return F.pow(F.lit(2.0), x.cast("double"))


def _rounded(value: Column, n: Column) -> Column:
    """A bit field's value as its column type holds it."""
    return F.when(n < 25, value.cast("float").cast("double")).otherwise(value)


def _raw_rows(words: Column, at: Column, k: Column, msb: Column, lsb: Column) -> tuple[Column, Column]:
    """(raw_field() as long, its value as double) of a field of any width; the long is null beyond 62 bits."""
    first, last = F.get(words, at).cast("long"), F.get(words, at + k - 1).cast("long")
    shift, mask = (lambda x, n: F.call_function("shiftright", x, n)), lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), n) - 1
    n = F.when(k == 1, lsb - msb + 1).otherwise(17 - msb + lsb + 16 * (k - 2))
    one = shift(first, 16 - lsb).bitwiseAND(mask(n))
    head, tail = first.bitwiseAND(mask(17 - msb)), shift(last, 16 - lsb)
    middle = F.slice(words, at + 2, F.greatest(k - 2, F.lit(0)))

    def total(kind: str) -> Column:
        wide = (lambda x: x.cast("decimal(6,0)")) if kind.startswith("dec") else lambda x: x
        inner = F.aggregate(middle, head.cast(kind), lambda a, x: (a * wide(F.lit(65536)) + x).cast(kind))
        return (inner * wide(F.call_function("shiftleft", F.lit(1), lsb)) + tail).cast(kind)

    whole = at + k <= F.size(words)
    long = F.when(k == 1, one).when((n <= LONG_BITS) & whole, total("long"))
    return long, F.when(n <= LONG_BITS, long.cast("double")).when((n <= DECIMAL_BITS) & whole, total("decimal(38,0)").cast("double")).when(whole, total("double"))


def decode_rows(words: Column, of: Callable[[str], Column] = F.col) -> Column:
    """The value as double of a 1553 element whose fields schema, offset, elem_word_count, bitmsb, bitlsb and msb_val `of` gives, by default columns of the row.

    One branch an encoding, however many elements there are. Missing words give null.
    """
    schema, at, k, msb, lsb, weight = (of(c) for c in ("schema", "offset", "elem_word_count", "bitmsb", "bitlsb", "msb_val"))
    w = [F.get(words, at + i).cast("long") for i in range(2)]
    n = F.when(k == 1, lsb - msb + 1).otherwise(17 - msb + lsb + 16 * (k - 2))
    scale = lambda bits: F.when(weight == 0, F.lit(1.0)).otherwise(weight / _power(bits))
    long, double = _raw_rows(words, at, k, msb, lsb)
    negative = F.call_function("shiftright", w[0], 16 - msb).bitwiseAND(F.lit(1)) == 1

    def signed(x: Column, bits: Column, below: Column) -> Column:
        return (x.cast("double") - F.when(below, _power(bits)).otherwise(F.lit(0.0))) * scale(bits - 2)

    value = F.when(schema == "UNSIGNEDBITS", F.when(n == 1, double).otherwise(_rounded(double * scale(n - 1), n)))
    value = value.when(schema == "SIGNEDBITS", _rounded(signed(double, n, negative), n))
    code = F.pmod(F.call_function("shiftright", F.get(words, at + k - 1).cast("long") + F.when(k > 1, F.get(words, at + k - 2).cast("long") * 65536).otherwise(0), 16 - lsb), F.lit(256))
    code = F.when(n < 8, long).otherwise(code)  # the last eight bits lie in the last two words
    value = value.when(schema == "ASCII", F.when(code > 127, code - 256).otherwise(code).cast("double"))
    whole = {1: w[0], 2: w[0] * 65536 + w[1]}
    for name, count in WORD_COUNTS.items():
        if name in _FLOATS:
            own = _FLOATS[name](words, at)
        else:
            own = whole[count].cast("double") * scale(F.lit(16 * count - 1)) if name.startswith("UNSIGNED") else signed(whole[count], F.lit(16 * count), w[0] >= 32768)
        value = value.when(schema == name, own.cast(output_type(name, 16 * count)).cast("double"))
    return value


def decode32_rows(of: Callable[[str], Column] = F.col) -> Column:
    """The value as double of a 429 element whose fields schema, bitmsb, bitlsb, msb_val and bcd_partial, and whose word's data, SSM, SDI and parity, `of` gives."""
    schema, msb, lsb, weight, partial = (of(c) for c in ("schema", "bitmsb", "bitlsb", "msb_val", "bcd_partial"))
    word = of("parity").cast("long") * F.lit(1 << 31) + of("SSM").cast("long") * F.lit(1 << 29) + of("data").cast("long") * F.lit(1 << 10)
    shift, bit = (lambda x, n: F.call_function("shiftright", x, n)), lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), n)
    n = lsb - msb + 1
    scale = lambda bits: F.when(weight == 0, F.lit(1.0)).otherwise(weight / _power(bits))
    raw = shift(word, 32 - lsb).bitwiseAND(bit(n) - 1)
    signed = (raw.cast("double") - F.when(raw >= bit(n - 1), _power(n)).otherwise(F.lit(0.0))) * scale(n - 2)
    size = raw.bitwiseAND(bit(n - 1) - 1).cast("double") * scale(n - 2)
    magnitude = F.when(raw.bitwiseAND(bit(n - 1)) != 0, -size).otherwise(size)
    rest, digits = n % 4, F.floor(n / 4).cast("int")
    lead, trail = F.when(partial < 0, rest).otherwise(F.lit(0)), F.when(partial > 0, rest).otherwise(F.lit(0))
    ten = lambda x: F.pow(F.lit(10.0), x.cast("double"))
    own = [F.when(F.lit(j) < digits, shift(raw, F.greatest(n - lead - 4 * (j + 1), F.lit(0))).bitwiseAND(F.lit(15)).cast("double") * ten(digits - 1 - j + F.when(trail > 0, 1).otherwise(0))).otherwise(F.lit(0.0)) for j in range(8)]
    decimal = F.when(lead > 0, shift(raw, n - lead).cast("double") * ten(digits)).otherwise(F.lit(0.0)) + _add(*own) + F.when(trail > 0, raw.bitwiseAND(bit(trail) - 1).cast("double")).otherwise(F.lit(0.0))
    value = F.when(schema == "UNSIGNEDBITS", F.when(n == 1, raw.cast("double")).otherwise(_rounded(raw.cast("double") * scale(n - 1), n)))
    value = value.when(schema == "SIGNEDBITS", _rounded(signed, n)).when(schema == "ASCII", ascii_code(raw).cast("double"))
    value = value.when(schema == "SIGNMAG", _rounded(magnitude, n)).when(schema == "BCD", _rounded(decimal * ssm_sign(of("SSM")), n))
    sdi = shift(of("SDI").cast("long"), F.greatest(24 - lsb, F.lit(0))).bitwiseAND(bit(n) - 1).cast("double")
    return F.when((msb >= 23) & (lsb <= 24), F.when(n == 1, (sdi != 0).cast("double")).otherwise(sdi)).otherwise(value)
