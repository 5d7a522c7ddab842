"""Reading of unit strings: dynamic programming over tries of prefixes, roots and exponents.

A strength such as ``x1000 IU / 5 ml``, ``0,75% w/w`` or ``mg. per tablet`` is cut into numbers,
scale words, prefixes, roots, exponents and separators. Each position and grammar phase keeps its
cheapest decomposition; the costs are priors on the dimensions a numerator or a denominator
has and on the prefixes a dimension is written with, so ``MG`` is milligram but ``MIU`` million
units.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Root spellings by (dimension, factor to the common unit). Common units: g, L, h, IU, Eq, mol, m, piece.
ROOTS = {
    ("mass", 1.0): "g gm gms gr gram grams gramme grammes",
    ("volume", 1.0): "l liter liters litre litres",
    ("volume", 1e-3): "cc",
    ("time", 1.0): "h hr hrs hour hours",
    ("time", 24.0): "d day days",
    ("time", 1 / 60): "min minute minutes",
    ("time", 168.0): "wk week weeks",
    ("iu", 1.0): "iu i.u. [iu] u unit units international_unit international_units usp_unit usp_units",
    ("eq", 1.0): "eq equivalent equivalents",
    ("mol", 1.0): "mol mole moles",
    ("length", 1.0): "m meter meters metre metres",
    ("piece", 1.0): "1 ea each tab tabs tablet tablets {tablet} cap caps capsule capsules {capsule} piece pieces patch patches "
    "suppository suppositories lozenge lozenges ampoule ampoules vial vials dose doses unit_dose actuation actuations spray sprays puff puffs",
}
# Prefixes by factor; short ones are case-sensitive by cost.
PREFIXES = {1e3: "k kilo", 1e6: "M mega", 1e-1: "deci", 1e-2: "c centi", 1e-3: "m milli", 1e-6: "u µ μ mc micro", 1e-9: "n nano"}
# Words that scale the number before them.
SCALES = {"thousand": 1e3, "x1000": 1e3, "x 1000": 1e3, "million": 1e6, "x1000000": 1e6, "billion": 1e9, "hundred": 1e2}
# Per cent notations -> numerator dimension, denominator dimension and the denominator's factor.
PERCENT = {"w/w": ("mass", "mass", 100.0), "w/v": ("mass", "volume", 0.1), "v/v": ("volume", "volume", 0.1), "": ("percent", "piece", 1.0)}
# Exponents.
EXPONENTS = {"2": 2, "²": 2, "^2": 2, "3": 3, "³": 3, "^3": 3}
#: Cost of a dimension in a field: what a numerator or a denominator usually is.
FIELD_COST = {
    "num": {"mass": 0.0, "iu": 0.2, "eq": 0.5, "mol": 0.8, "volume": 1.0, "percent": 1.0, "piece": 2.0, "time": 4.0, "length": 5.0},
    "den": {"piece": 0.0, "volume": 0.1, "mass": 0.4, "time": 0.5, "length": 3.0, "iu": 4.0, "eq": 4.0, "mol": 4.0},
}
#: Cost of a prefix with a dimension; others cost 2.
PREFIX_COST = {
    ("mass", 1e-3): 0.0, ("mass", 1e-6): 0.1, ("mass", 1e-9): 0.6, ("mass", 1e3): 0.6, ("mass", 1e6): 9.0,
    ("volume", 1e-3): 0.0, ("volume", 1e-6): 0.5, ("volume", 1e-1): 0.6, ("volume", 1e-2): 1.0,
    ("iu", 1e3): 0.1, ("iu", 1e6): 0.2, ("iu", 1e-3): 1.0, ("eq", 1e-3): 0.0, ("mol", 1e-3): 0.0, ("mol", 1e-6): 0.3,
    ("length", 1e-2): 0.0, ("length", 1e-3): 0.2,
}
#: Cost of a short prefix written in the other case (M/m change the meaning).
CASE_COST = 0.95
_NUMBER = re.compile(r"\d[\d.,]*")


def _trie(words: list[tuple[str, object]]) -> dict:
    top: dict = {}
    for word, what in words:
        node = top
        for ch in word.replace("_", " "):
            node = node.setdefault(ch, {})
        node.setdefault("", []).append((word, what))
    return top


_ROOT = _trie([(w, k) for k, ws in ROOTS.items() for w in ws.split()])
_PREFIX = _trie([(w.lower(), (f, w)) for f, ws in PREFIXES.items() for w in ws.split()])
_SCALE = _trie(list(SCALES.items()))
_EXPONENT = _trie(list(EXPONENTS.items()))
_PERCENT = _trie([(w, None) for w in ("%", "percent", "per cent", "pct")])
_RATIO = _trie([(f"{a}{r}{b}", r) for r in ("w/w", "w/v", "v/v") for a, b in (("", ""), ("(", ")"))])


def _walk(trie: dict, s: str, i: int):
    """All entries that begin at i: (end, payload)."""
    while True:
        for _, what in trie.get("", ()):
            yield i, what
        if i >= len(s) or s[i] not in trie:
            return
        trie, i = trie[s[i]], i + 1


def read_number(text: str) -> float | None:
    """``1,000`` and ``1,000.5`` have thousands, ``0,5`` and ``1,25`` a decimal comma."""
    t = text.rstrip(".,")
    if re.fullmatch(r"[1-9]\d{0,2}(,\d{3})+(\.\d+)?", t):
        t = t.replace(",", "")
    elif re.fullmatch(r"\d+,\d+", t):
        t = t.replace(",", ".")
    return float(t) if re.fullmatch(r"\d+(\.\d+)?", t) else None


@lru_cache(maxsize=65536)
def segment(text: str, field: str = "num") -> tuple[float | None, float, str, float, str | None] | None:
    """The cheapest decomposition: (number in the text, numerator factor, its dimension,
    denominator factor, its dimension or None), or None where the text isn't a unit.

    ``field`` is ``num`` or ``den``: what column the text stands in. Null-free input; blank gives None.
    """
    raw = " ".join(text.split())
    s = raw.lower()
    n = len(s)
    # (position, phase) -> (cost, number, numerator factor, dimension, denominator factor, dimension, last root's factor)
    best: dict[tuple[int, str], tuple] = {(0, "start"): (0.0, None, 1.0, None, 1.0, None, None)}
    ends = [None]

    def put(i: int, phase: str, state: tuple) -> None:
        if (i, phase) not in best or state[0] < best[i, phase][0]:
            best[i, phase] = state

    def root(i: int, state: tuple, side: str, prior: str, prefix: float | None) -> None:
        cost, number, nf, nd, df, dd, _ = state
        for j, (dim, factor) in _walk(_ROOT, s, i):
            # A root ends at a word's end.
            if j < n and s[j - 1].isalpha() and s[j].isalpha():
                continue
            if prefix is not None and dim in ("piece", "time"):
                continue
            c = cost + 1 + FIELD_COST[prior].get(dim, 3.0) + (PREFIX_COST.get((dim, prefix), 2.0) if prefix else 0)
            f = factor * (prefix or 1.0)
            if side == "num":
                put(j, "unit", (c, number, nf * f, dim, df, dd, f))
            else:
                put(j, "below", (c, number, nf, nd, df * f, dim, f))

    for i in range(n + 1):
        # Phases in an order in which blank steps at one position lead forward only.
        for phase in ("start", "percent", "unit", "den", "below"):
            state = best.get((i, phase))
            if state is None:
                continue
            cost, number, nf, nd, df, dd, last = state
            if i == n:
                if phase in ("unit", "below", "percent"):
                    if phase == "percent":
                        nd, dd, f = PERCENT[""]
                        state = (cost, number, nf, nd, df * f, dd, None)
                    if ends[0] is None or cost < ends[0][0]:
                        ends[0] = state
                continue
            if s[i] == " " or (s[i] == "." and phase in ("unit", "below")):
                put(i + 1, phase, (cost + 0.01, *state[1:]))
            if phase in ("start", "den"):
                top = "num" if phase == "start" else "den"
                if m := _NUMBER.match(s, i):
                    value = read_number(m.group())
                    if value is not None and (phase == "den" or number is None):
                        j = i + len(m.group().rstrip(".,"))
                        put(j, phase, (cost + 0.5, value, *state[2:]) if phase == "start" else (cost + 0.5, number, nf, nd, df * value, dd, last))
                if phase == "start":
                    for j, f in _walk(_SCALE, s, i):
                        put(j, phase, (cost + 0.5, number, nf * f, nd, df, dd, last))
                    for j, _ in _walk(_PERCENT, s, i):
                        put(j, "percent", (cost + 1, *state[1:]))
                for j, (f, written) in _walk(_PREFIX, s, i):
                    odd = len(written) == 1 and raw[i : i + 1] != written
                    # A prefix of either case is tried at once with every root, for m and M share a position.
                    root(j, (cost + 0.5 + CASE_COST * odd, number, nf, nd, df, dd, f), top, field if top == "num" else "den", f)
                root(i, state, top, field if top == "num" else "den", None)
            elif phase == "percent":
                for j, ratio in _walk(_RATIO, s, i):
                    top, low, f = PERCENT[ratio]
                    put(j, "below", (cost + 0.5, number, nf, top, df * f, low, None))
            elif phase == "unit":
                for j, e in _walk(_EXPONENT, s, i):
                    if last and nd == "length":
                        put(j, "unit", (cost + 0.5, number, nf / last * last**e, f"length{e}", df, dd, None))
                if s[i] == "/":
                    put(i + 1, "den", (cost + 0.3, *state[1:]))
                elif s.startswith("per", i) and (i + 3 == n or not s[i + 3].isalpha()) and s[i - 1] in " .":
                    put(i + 3, "den", (cost + 0.3, *state[1:]))
            elif phase == "below":
                for j, e in _walk(_EXPONENT, s, i):
                    if last and dd == "length":
                        put(j, "below", (cost + 0.5, number, nf, nd, df / last * last**e, f"length{e}", None))
    if ends[0] is None:
        return None
    _, number, nf, nd, df, dd, _ = ends[0]
    return number, nf, nd, df, dd


def common_quantity(num: float | None, num_unit: str | None, den: float | None, den_unit: str | None) -> tuple[float, str] | None:
    """(value, kind) in common units, kind like ``mass/volume``; None where it can't be read.

    A number may stand in its column or in the unit's text, not in both. Without a denominator,
    or with one that counts pieces, the strength is per piece.
    """
    if num_unit is None or not num_unit.strip():
        return None
    got = segment(num_unit, "num")
    if got is None:
        return None
    number, nf, nd, df, dd = got
    if (number is None) == (num is None):
        return None
    value = (num if number is None else number) * nf
    below = 1.0 if den is None else den
    if den_unit is not None and den_unit.strip():
        d = segment(den_unit.strip(), "den")
        if d is None or d[4] is not None:
            return None
        below *= d[1] * (1.0 if d[0] is None else d[0])
        if dd is not None and not (dd == d[2] or d[2] == "piece"):
            return None
        if dd is None:
            dd = d[2]
    below *= df
    if value < 0 or below <= 0:
        return None
    return value / below, f"{nd}/{dd or 'piece'}"


@F.pandas_udf(T.StructType([T.StructField("value", T.DoubleType()), T.StructField("kind", T.StringType())]))
def _quantity(num: pd.Series, num_unit: pd.Series, den: pd.Series, den_unit: pd.Series) -> pd.DataFrame:
    clean = lambda s: [None if x is None or x != x else x for x in s]
    out = [common_quantity(*row) or (None, None) for row in zip(*map(clean, (num, num_unit, den, den_unit)), strict=True)]
    return pd.DataFrame(out, columns=["value", "kind"]).astype({"value": "float64"})


def quantity(num: Column, num_unit: Column, den: Column, den_unit: Column) -> Column:
    """Column form of :func:`common_quantity`: struct(value, kind), its fields null where unreadable."""
    return _quantity(num.cast("double"), num_unit, den.cast("double"), den_unit)
