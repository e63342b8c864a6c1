"""Bit fields of packet and message headers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bits(x: Column, at: int, n: int = 1) -> Column:
    """n bits from bit `at` (0: least significant) as int."""
    return F.shiftright(x, at).bitwiseAND(F.lit((1 << n) - 1)).cast("int")


def is_set(x: Column, at: int) -> Column:
    return bits(x, at) == 1


def command_word(w: Column) -> dict[str, Column]:
    return {"rtaddr": bits(w, 11, 5), "tr": bits(w, 10), "subaddr": bits(w, 5, 5), "wrdcnt": bits(w, 0, 5)}


def transfer(word1: Column, word2: Column, rt_to_rt: Column, transmit: Column) -> dict[str, Column]:
    """Transmit and receive command of a message: its two words swapped for RT to RT, else one of them and 0."""
    return {"txcommwrd": F.when(rt_to_rt, word2).when(transmit, word1).otherwise(0), "rxcommwrd": F.when(rt_to_rt | ~transmit, word1).otherwise(0)}


def is_mode_code(subaddr1: Column) -> Column:
    return ~((subaddr1 > 0) & (subaddr1 < 31))


def expected_words(subaddr1: Column, wrdcnt1: Column, rt_to_rt: Column) -> Column:
    """Data words that a command announces: a mode code has one from 16 on, a count of 0 is 32."""
    mode = ~rt_to_rt & subaddr1.isin(0, 31)
    return F.when(mode, F.when(wrdcnt1 > 15, 1).otherwise(0)).when(wrdcnt1 == 0, 32).otherwise(wrdcnt1)


def payload_words(length: Column, expected: Column, rt_to_rt: Column, transmit: Column) -> dict[str, Column]:
    """Data words that are there, at most those expected, and whether some are missing. length: of the message in bytes."""
    there = F.floor(length / 2).cast("int") - F.when(rt_to_rt, 3).when(transmit, 2).otherwise(1)
    return {"calcwrdcnt": F.least(there, expected), "incomplete": there < expected}


def status_places(length: Column, subaddr1: Column, wrdcnt1: Column, rt_to_rt: Column, transmit: Column) -> dict[str, Column]:
    """Place (from 0) of the first and second status word among a message's words, -1 if there is none."""
    n, data = F.floor(length / 2).cast("int"), expected_words(subaddr1, wrdcnt1, rt_to_rt)
    mode = F.when(subaddr1 == 31, -1).when((wrdcnt1 > 15) & ~transmit, F.when(n >= 3, 2).otherwise(-1)).otherwise(F.when(n >= 2, 1).otherwise(-1))
    one = F.when(transmit, F.when(n >= 2, 1).otherwise(-1)).otherwise(F.when(n >= data + 2, data + 1).otherwise(-1))
    first = F.when(rt_to_rt, F.when(n > 2, 2).otherwise(-1)).when(subaddr1.isin(0, 31), mode).otherwise(one)
    return {"status1": first, "status2": F.when(rt_to_rt & (n >= data + 4), data + 3).otherwise(-1)}


def status_word(w: Column) -> dict[str, Column]:
    names = {"terminal": 0, "dynbusctrl": 1, "subsys": 2, "busy": 3, "bcastrcv": 4, "svcreq": 8, "instr": 9, "msgerr": 10}
    return {k: is_set(w, at) for k, at in names.items()} | {"rtaddr": bits(w, 11, 5)}


def header_1553(block_status: Column, gaps: Column) -> dict[str, Column]:
    names = {"WE": 3, "SE": 4, "WCE": 5, "TO": 9, "FE": 10, "RR": 11, "ME": 12, "bus_dir": 13}
    return {k: is_set(block_status, at) for k, at in names.items()} | {"gap1": bits(gaps, 0, 8), "gap2": bits(gaps, 8, 8)}


def header_429(word: Column) -> dict[str, Column]:
    return {"gap": bits(word, 0, 20), "BS": is_set(word, 21), "PE": is_set(word, 22), "FE": is_set(word, 23), "bus": bits(word, 24, 8)}


def word_429(word: Column) -> dict[str, Column]:
    return {"label_raw": bits(word, 0, 8), "SDI": bits(word, 8, 2), "data": bits(word, 10, 19), "SSM": bits(word, 29, 2), "parity": bits(word, 31)}


def octal_label(raw: Column) -> Column:
    """Label byte, whose bits come in reverse, as octal digits read as a decimal number."""
    b = sum((bits(raw, i) * (1 << (7 - i)) for i in range(1, 8)), bits(raw, 0) * 128)
    return bits(b, 6, 2) * 100 + bits(b, 3, 3) * 10 + bits(b, 0, 3)


def video_flags(word: Column) -> dict[str, Column]:
    return {"BA": is_set(word, 23), "PL": bits(word, 24, 4), "KLV": is_set(word, 28), "SRS": is_set(word, 29), "IPH": is_set(word, 30), "ET": is_set(word, 31)}
