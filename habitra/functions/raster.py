"""Pixel expressions: reflectance, cloud masks, spectral indices, surface water."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def reflectance(dn: Column) -> Column:
    """Surface reflectance of a scaled integer."""
    return dn * F.lit(0.0000275) - F.lit(0.2)


#: Two-bit confidences that count as cloud, and scene classes that do.
QA_LEVELS = {"low": (1, 2, 3), "medium": (2, 3), "high": (3,)}
QA_MEDIUM_AS_PUBLISHED = (1, 3)  # with compat: the two bits read in reverse
SCL_LEVELS = {"medium": (8, 9), "high": (9,)}
SCL_CIRRUS = 10


def qa_cloud(qa: Column, level: str = "high", cirrus: bool = True, compat: bool = False) -> Column:
    """Whether the quality bits say cloud (bits 8-9) or, with ``cirrus``, cirrus (bits 14-15) at that confidence."""
    if level not in QA_LEVELS:
        raise ValueError(f"unknown confidence {level!r}")
    values = QA_MEDIUM_AS_PUBLISHED if compat and level == "medium" else QA_LEVELS[level]
    bits = qa.cast("int")
    hit = F.shiftright(bits, 8).bitwiseAND(F.lit(3)).isin(*values)
    return hit | F.shiftright(bits, 14).bitwiseAND(F.lit(3)).isin(*values) if cirrus else hit


def scl_cloud(scl: Column, level: str = "medium", cirrus: bool = True) -> Column:
    """Whether a scene class is cloud at that confidence, or cirrus."""
    if level not in SCL_LEVELS:
        raise ValueError(f"unknown confidence {level!r}")
    return scl.isin(*SCL_LEVELS[level], *((SCL_CIRRUS,) if cirrus else ()))


def cloud_mask(band: str, value: Column, level: str = "high", cirrus: bool = True) -> Column:
    """The mask by the name of the quality band, whatever its case."""
    name = band.lower()
    if name in ("qa_pixel", "bqa", "cloud_mask"):
        return qa_cloud(value, level, cirrus)
    if name == "scl":
        return scl_cloud(value, level, cirrus)
    raise ValueError(f"no mask is known for the band {band!r}")


_TOKEN = re.compile(r"\s*(?:(\[[A-Za-z0-9_]+\])|(\d+(?:\.\d*)?(?:[eE][+-]?\d+)?)|(\*\*|[-+*/()]))")


class _Formula:
    """A recursive reader of arithmetic over ``[band]`` references; nothing is evaluated but these signs."""

    def __init__(self, text: str):
        self.tokens: list[str] = []
        at = 0
        while at < len(text.rstrip()):
            m = _TOKEN.match(text, at)
            if not m:
                raise ValueError(f"unexpected sign in formula at {text[at:]!r}")
            self.tokens.append(m[1] or m[2] or m[3])
            at = m.end()
        self.at = 0

    def peek(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else ""

    def take(self) -> str:
        self.at += 1
        return self.tokens[self.at - 1]

    def total(self) -> Column:
        out = self.product()
        while self.peek() in ("+", "-"):
            out = out + self.product() if self.take() == "+" else out - self.product()
        return out

    def product(self) -> Column:
        out = self.signed()
        while self.peek() in ("*", "/"):
            out = out * self.signed() if self.take() == "*" else F.try_divide(out, self.signed())
        return out

    def signed(self) -> Column:
        if self.peek() in ("-", "+"):
            return -self.signed() if self.take() == "-" else self.signed()
        base = self.atom()
        if self.peek() == "**":
            self.take()
            return F.pow(base, self.signed())
        return base

    def atom(self) -> Column:
        t = self.take() if self.peek() else ""
        if t == "(":
            out = self.total()
            if not self.peek() or self.take() != ")":
                raise ValueError("a bracket isn't closed")
            return out
        if t.startswith("["):
            return F.col(f"`{t[1:-1]}`")
        if t and t[0].isdigit():
            return F.lit(float(t))
        raise ValueError(f"unexpected {t!r} in formula")


def formula(text: str) -> Column:
    """An index formula such as ``([nir08]-[red]) / ([nir08]+[red])``; division by zero gives NULL."""
    reader = _Formula(text)
    out = reader.total()
    if reader.peek():
        raise ValueError(f"unexpected {reader.peek()!r} in formula")
    return out


def normalised_difference(a: Column, b: Column, scale: float = 1.0) -> Column:
    return F.try_divide(a - b, a + b) * F.lit(float(scale))


def water_indices(blue: Column, green: Column, red: Column, nir: Column, swir1: Column, swir2: Column, scale: float = 10000.0) -> dict[str, Column]:
    """The indices that the water tests read; ``scale`` holds for the two normalised differences."""
    return {
        "mndwi": normalised_difference(green, swir1, scale),
        "mbsr": (green + red) - (nir + swir1),
        "ndvi": normalised_difference(nir, red, scale),
        "awesh": blue + 2.5 * green - 1.5 * (nir + swir1) - 0.25 * swir2,
    }


#: Thresholds of the five water tests.
WATER_PARAMS = {
    "wigt": 124, "awgt": 0,
    "pswt_1_mndwi": -4400, "pswt_1_swir1": 9000, "pswt_1_nir": 15000, "pswt_1_ndvi": 7000,
    "pswt_2_mndwi": -5000, "pswt_2_blue": 1000, "pswt_2_nir": 2500, "pswt_2_swir1": 3000, "pswt_2_swir2": 1000,
}


def water_tests(px: dict[str, Column], params: dict[str, float] | None = None) -> Column:
    """The code t1 + 10 t2 + 100 t3 + 1000 t4 + 10000 t5 of the five tests; a test on a missing value fails.

    ``px`` has blue, nir, swir1, swir2 and the water indices.
    """
    p = WATER_PARAMS | (params or {})
    tests = [
        px["mndwi"] > p["wigt"],
        px["mbsr"] > 0,
        px["awesh"] > p["awgt"],
        (px["mndwi"] > p["pswt_1_mndwi"]) & (px["swir1"] < p["pswt_1_swir1"]) & (px["nir"] < p["pswt_1_nir"]) & (px["ndvi"] < p["pswt_1_ndvi"]),
        (px["mndwi"] > p["pswt_2_mndwi"]) & (px["blue"] < p["pswt_2_blue"]) & (px["nir"] < p["pswt_2_nir"]) & (px["swir1"] < p["pswt_2_swir1"]) & (px["swir2"] < p["pswt_2_swir2"]),
    ]
    out = F.lit(0)
    for k, t in enumerate(tests):
        out = out + F.when(t, F.lit(10**k)).otherwise(F.lit(0))
    return out


def water_class(code: Column) -> Column:
    """0 not water, 1 water, 2 water with moderate confidence, 3 wetland, 4 low confidence, by the tests that passed.

    Four or five tests: 1; three: 2; the last two alone: 3; any other two, or the last one alone: 4; else 0.
    """
    passed = F.lit(0)
    for k in range(5):
        passed = passed + F.floor(code / F.lit(10**k)).cast("int") % 10
    return F.when(passed >= 4, 1).when(passed == 3, 2).when(code == 11000, 3).when((passed == 2) | (code == 10000), 4).otherwise(0)
