"""Minimal SAS transport (XPORT v5) writer, for test files only: the public
record layout (80-byte header records, 140-byte variable descriptors, IBM
hexadecimal floats). Numeric columns are 8-byte floats; text columns fixed
width."""

from __future__ import annotations

import math
import struct

STAMP = "01JAN20:00:00:00"


def _rec(text: str) -> bytes:
    b = text.encode("ascii")
    assert len(b) <= 80
    return b.ljust(80, b" ")


def _header(kind: str, tail: str = "0" * 30) -> bytes:
    return _rec(f"HEADER RECORD*******{kind:<8}HEADER RECORD!!!!!!!{tail}")


def ibm_float(x) -> bytes:
    """IEEE double -> IBM System/370 8-byte hexadecimal float; None -> missing."""
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return b"." + b"\x00" * 7
    if x == 0:
        return b"\x00" * 8
    sign = 0x80 if x < 0 else 0
    x = abs(float(x))
    exp = 0
    frac = x
    while frac >= 1:
        frac /= 16
        exp += 1
    while frac < 1 / 16:
        frac *= 16
        exp -= 1
    mant = int(round(frac * (1 << 56)))
    if mant >= 1 << 56:
        mant >>= 4
        exp += 1
    return bytes([sign | (exp + 64)]) + mant.to_bytes(7, "big")


def write_xport(path: str, name: str, columns: list[tuple[str, str, int]], rows: list[tuple]) -> None:
    """columns: (name, 'num' | 'char', width); rows: tuples in column order."""
    out = bytearray()
    out += _header("LIBRARY")
    out += _rec("SAS     SAS     SASLIB  6.06    bsd4.2  " + " " * 24 + STAMP)
    out += _rec(STAMP)
    out += _header("MEMBER", "000000000000000001600000000140")
    out += _header("DSCRPTR")
    out += _rec("SAS     " + f"{name:<8}" + "SASDATA 6.06    bsd4.2  " + " " * 24 + STAMP)
    out += _rec(STAMP + " " * 16 + " " * 40 + " " * 8)
    out += _header("NAMESTR", f"000000{len(columns):04d}" + "0" * 20)
    desc = bytearray()
    pos = 0
    for i, (col, kind, width) in enumerate(columns, start=1):
        width = 8 if kind == "num" else width
        desc += struct.pack(
            ">hhhh8s40s8shhh2s8shhl52s",
            1 if kind == "num" else 2, 0, width, i,
            col.encode().ljust(8), b" " * 40, b" " * 8, 0, 0, 0, b"  ", b" " * 8, 0, 0, pos, b"\x00" * 52,
        )
        pos += width
    if len(desc) % 80:
        desc += b" " * (80 - len(desc) % 80)
    out += desc
    out += _header("OBS")
    data = bytearray()
    for r in rows:
        for (col, kind, width), v in zip(columns, r):
            if kind == "num":
                data += ibm_float(v)
            else:
                data += (v or "").encode().ljust(width)[:width]
    if len(data) % 80:
        data += b" " * (80 - len(data) % 80)
    out += data
    with open(path, "wb") as fh:
        fh.write(out)
