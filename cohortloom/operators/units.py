"""Quantities recorded in different units, converted to one.

Unit text ("mths", "mg/kg", "d⁻¹") is segmented by dynamic programming over tries of
prefixes, roots and exponents; where a string can be cut in several ways ("m" is month,
minute, metre or molar, "mm" millimetre or millimolar) the readings are scored with a
prior for the field's dimension.  A unit that reads best as another dimension makes the
value no quantity of the field.  The work is done once for each distinct shape of a value
(its text with the numbers masked), and the numbers are then converted by column
arithmetic.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.clinical import DAYS, column_slug, leading_number
from cohortloom.functions.keys import NULL_MARKS, normal_key, real_value, stripped
from cohortloom.session import bounded, ship

# Dimensions as exponents of (time, length, mass, amount, count); their base units are day, metre, gram, mole and piece.
DIMENSIONS = {
    "time": (1, 0, 0, 0, 0), "length": (0, 1, 0, 0, 0), "area": (0, 2, 0, 0, 0), "volume": (0, 3, 0, 0, 0), "mass": (0, 0, 1, 0, 0), "amount": (0, 0, 0, 1, 0), "count": (0, 0, 0, 0, 1),
    "rate": (-1, 0, 0, 0, 0), "dose": (0, 0, 0, 0, 0), "daily_dose": (-1, 0, 0, 0, 0), "area_dose": (0, -2, 1, 0, 0), "mass_concentration": (0, -3, 1, 0, 0), "amount_concentration": (0, -3, 0, 1, 0), "count_concentration": (0, -3, 0, 0, 1),
}
# Kinds of roots that are usual in a field of a dimension.
USUAL = {
    "time": ("time",), "length": ("length",), "area": ("length",), "volume": ("volume", "length"), "mass": ("mass",), "amount": ("amount",), "count": ("count",), "rate": ("time", "count"), "dose": ("mass",), "daily_dose": ("mass", "time"),
    "area_dose": ("mass", "length"), "mass_concentration": ("mass", "volume"), "amount_concentration": ("amount", "volume", "amount_concentration"), "count_concentration": ("count", "volume"),
}
# Unit roots as (names, kind, size in the kind's base units, whether decimal prefixes go with it).
ROOTS = [
    (("day", "d", "dy", "tag", "jour", "dia", "día"), "time", 1.0, False),
    (("week", "w", "wk", "woche", "semaine", "semana"), "time", 7.0, False),
    (("month", "mo", "mth", "mon", "mnth", "m", "monat", "mois", "mes"), "time", 30.4375, False),
    (("year", "y", "yr", "jahr", "annum", "année", "año", "ano"), "time", 365.25, False),
    (("fortnight",), "time", 14.0, False),
    (("decade",), "time", 3652.5, False),
    (("hour", "h", "hr", "stunde", "heure", "hora"), "time", 1 / 24, False),
    (("minute", "min", "m"), "time", 1 / 1440, False),
    (("second", "s", "sec"), "time", 1 / 86400, True),
    (("metre", "meter", "m"), "length", 1.0, True),
    (("gram", "g"), "mass", 1.0, True),
    (("litre", "liter", "l"), "volume", 1e-3, True),
    (("mole", "mol"), "amount", 1.0, True),
    (("molar", "m"), "amount_concentration", 1e3, True),
    (("cycle", "dose", "visit", "patient", "cell", "copy", "iu"), "count", 1.0, False),
]
# Decimal prefixes.
PREFIXES = {"kilo": 1e3, "k": 1e3, "milli": 1e-3, "m": 1e-3, "micro": 1e-6, "u": 1e-6, "µ": 1e-6, "μ": 1e-6, "nano": 1e-9, "n": 1e-9, "pico": 1e-12, "p": 1e-12, "centi": 1e-2, "c": 1e-2, "deci": 1e-1, "d": 1e-1}
# Exponents after a root.
EXPONENTS = {"²": 2, "^2": 2, "2": 2, "³": 3, "^3": 3, "3": 3, "-1": -1, "^-1": -1, "⁻¹": -1, "-2": -2, "^-2": -2, "⁻²": -2, "-3": -3, "^-3": -3, "⁻³": -3}
# What joins two roots, and the sign it gives the exponents behind it.
JOINTS = {"/": -1, " / ": -1, " per ": -1, "·": 1, "*": 1, ".": 1, " ": 1}
# Plural endings of a root.
ENDINGS = ("s", "(s)", "e", "en", "n")
# Number words.
SMALL_NUMBERS = {w: i for i, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())}
TENS = {w: 10 * i for i, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split(), 2)}
GROUPS = {"half": 0.5, "couple": 2, "dozen": 12, "hundred": 100}
# Words of approximation and censoring beside a number.
HEDGES = {"ca", "circa", "approx", "about", "around", "over", "at", "least", "more", "than", "less", "under", "almost", "nearly", "to", "in", "of", "and", "as"}
# Units as words that tell nothing.
UNTOLD = {"", "---", "NONE", "UNKNOWN", "NA", "N/A", "OTHER"}
#: Log weights of a reading: a root that isn't usual in the field, a rare root, a prefix (before one letter), an ending, an exponent.
UNUSUAL, PREFIXED, SHORT_PREFIXED, ENDED, RAISED = -6.0, -2.0, -2.0, -0.1, -1.0
RARE_ROOT = {"hour": -1.0, "minute": -3.0, "second": -3.0, "year": -0.1, "cycle": -1.0}
PRIORS = {field: {kind: 0.0 if kind in usual else UNUSUAL for kind in DIMENSIONS} for field, usual in USUAL.items()}
#: No unit of the field's dimension reads worse.
LEAST_SCORE = -8.0
#: Beyond so many distinct shapes or columns their rules are shuffled, not broadcast.
BROADCAST_RULES = 200_000


def _trie(words: dict) -> dict:
    root: dict = {}
    for word, value in words.items():
        node = root
        for ch in word:
            node = node.setdefault(ch, {})
        node.setdefault("", []).extend(value if isinstance(value, list) else [value])
    return root


def _root_words() -> dict:
    words: dict = {}
    for names, kind, size, scaled in ROOTS:
        for name in names:
            words.setdefault(name, []).append((names[0], kind, size, scaled))
    return words


_ROOT_TRIE, _PREFIX_TRIE, _EXPONENT_TRIE, _ENDING_TRIE, _JOINT_TRIE = _trie(_root_words()), _trie(PREFIXES), _trie(EXPONENTS), _trie(dict.fromkeys(ENDINGS, 1)), _trie(JOINTS)


def _walk(trie: dict, text: str, at: int):
    """(end, value) of every word of the trie that starts at a place."""
    node = trie
    for i in range(at, len(text) + 1):
        for value in node.get("", ()):
            yield i, value
        if i == len(text) or text[i] not in node:
            return
        node = node[text[i]]


def _times(vector: tuple, kind: str, power: int) -> tuple:
    return tuple(v + power * k for v, k in zip(vector, DIMENSIONS[kind], strict=True))


_PLAIN = DIMENSIONS["dose"]


def unit_readings(text: str, dimension: str) -> dict[tuple, tuple[float, float]]:
    """{exponents: (score, size)} of the best reading of a unit text for each dimension it can have.

    A state of the dynamic programme is the place in the text, the part of speech read
    last (joint, prefix, root, ending, exponent), and the dimension so far; it keeps the
    best score.  A reading must use the whole text.  The factor being read is
    held apart (its kind, its size with prefix, its sign) until its exponent is known.
    """
    prior = PRIORS[dimension]
    # (place, part, vector, kind, sign, scaled prefix) -> (score, size of the closed factors, size of the open one)
    states: dict[tuple, tuple[float, float, float]] = {(0, "joint", _PLAIN, None, 1): (0.0, 1.0, 1.0)}
    if text.startswith("/"):
        states = {(1, "joint", _PLAIN, None, -1): (0.0, 1.0, 1.0)}
    ends: dict[tuple, tuple[float, float]] = {}
    for at in range(len(text) + 1):
        for part in ("joint", "prefix", "root", "ending", "exponent"):
            for key in [k for k in states if k[0] == at and k[1] == part]:
                score, size, open_size = states[key]
                _, _, vector, kind, sign = key
                steps = []
                if part == "joint":
                    steps += [((end, "prefix", vector, None, sign), (score + PREFIXED, size, v)) for end, v in _walk(_PREFIX_TRIE, text, at) if end > at]
                if part in ("joint", "prefix"):
                    for end, (name, k, v, scaled) in _walk(_ROOT_TRIE, text, at):
                        if end > at and (scaled or part == "joint"):
                            short = SHORT_PREFIXED if part == "prefix" and end - at < 2 and k == "time" else 0.0
                            read = (score + prior[k] + RARE_ROOT.get(name, 0.0) + short, size, open_size * v if part == "prefix" else v)
                            steps.append(((end, "root", vector, k, sign), read))
                            # A short sign has no ending but the s of a plural.
                            steps += [((to, "ending", vector, k, sign), (read[0] + ENDED, *read[1:])) for to, _ in _walk(_ENDING_TRIE, text, end) if to > end and (end - at > 2 or "s" in text[end:to])]
                if part in ("root", "ending"):
                    for end, power in _walk(_EXPONENT_TRIE, text, at):
                        if end > at:
                            steps.append(((end, "exponent", _times(vector, kind, sign * power), None, sign), (score + RAISED, size * open_size ** (sign * power), 1.0)))
                if part in ("root", "ending", "exponent"):
                    closed = (vector, size) if part == "exponent" else (_times(vector, kind, sign), size * open_size**sign)
                    steps += [((end, "joint", closed[0], None, s), (score, closed[1], 1.0)) for end, s in _walk(_JOINT_TRIE, text, at) if end > at]
                    if at == len(text) and (closed[0] not in ends or score > ends[closed[0]][0]):
                        ends[closed[0]] = (score, closed[1])
                for to, value in steps:
                    if to not in states or value[0] > states[to][0]:
                        states[to] = value
    return ends


@lru_cache(maxsize=65536)
def read_unit(text: str, dimension: str = "time") -> tuple[tuple, float, float] | None:
    """(exponents, size in base units, score) of the best reading of a unit in a field of a dimension, or None."""
    text = re.sub(r"\s+", " ", text.strip(" .[]()").lower())
    ends = unit_readings(text, dimension) if text else {}
    if not ends:
        return None
    vector, (score, size) = max(ends.items(), key=lambda e: (*e[1], e[0]))
    return vector, size, score


def segment_unit(text: str, dimension: str = "time") -> tuple[float, float] | None:
    """(size in the dimension's base, score) of a unit text, or None if it is no unit or reads best as one of another dimension."""
    best = read_unit(text, dimension)
    return (best[1], best[2]) if best and best[0] == DIMENSIONS[dimension] and best[2] > LEAST_SCORE else None


def unit_of_name(name: str, dimension: str = "time") -> float | None:
    """The unit a column name tells by one of its words; words of one letter only at an end or in brackets."""
    words = [w for w in re.split(r"[^a-z0-9µμ²³^/]+", name.lower()) if w.strip("/")]
    told = []
    for i, word in enumerate(words):
        if len(word) <= 1 and i not in (0, len(words) - 1) or len(words) == 1 and len(word) <= 2 or word in ("an", "a", "mes", "s", "min", "sec", "dia"):
            continue
        found = segment_unit(word, dimension)
        if found:
            told.append((len(word) > 1, i, found[0]))
    return max(told)[2] if told else None


_WORD = r"[^\W\d_]+(?:⁻?[¹²³])?"
_TOKEN = re.compile(rf"#|/?{_WORD}\.?(?:[/·*]{_WORD})*(?: {_WORD}⁻[¹²³])*", re.UNICODE)
_ISO = re.compile(r"p(?:#y)?(?:#m)?(?:#w)?(?:#d)?")


def _number_words(tokens: list[str]) -> list[tuple[str, float]]:
    """(token, value) of each token; a run of number words is one token ('', its value)."""
    out: list[tuple[str, float]] = []
    i = 0
    while i < len(tokens):
        value, j = None, i
        while j < len(tokens):
            word, nxt = tokens[j].rstrip("."), tokens[j + 1] if j + 1 < len(tokens) else ""
            if word in TENS:
                value = (value or 0) + TENS[word]
            elif word in SMALL_NUMBERS and (value is None or value % 10 == 0 and value >= 20):
                value = (value or 0) + SMALL_NUMBERS[word]
            elif word in GROUPS and word != "half":
                value = (1 if value is None else value) * GROUPS[word]
            elif word == "half":
                value = (value or 0) + 0.5
            elif word in ("a", "an") and (nxt in GROUPS or value is None and nxt and nxt not in HEDGES and read_unit(nxt) is not None):
                value = value if nxt in GROUPS or value is not None else 1
            elif word == "and" and value is not None and (nxt in ("a", "one") and tokens[j + 2 : j + 3] == ["half"] or nxt in SMALL_NUMBERS or nxt in TENS):
                if nxt == "one" and tokens[j + 2 : j + 3] == ["half"]:
                    value, j = value + 0.5, j + 2
            elif word == "and" and value is None and out and out[-1][0] == "#" and nxt in ("a", "one") and tokens[j + 2 : j + 3] == ["half"]:
                value, j = 0.5, j + 2
            elif word in ("a", "an") and value == 0.5:
                pass  # half a year
            else:
                break
            j += 1
        if value is None:
            out.append((tokens[i], math.nan))
            i += 1
        else:
            out.append(("", float(value)))
            i = j
    return out


def shape_rule(shape: str, dimension: str = "time") -> str | None:
    """How the numbers of a shape make a quantity, or None if it holds none of the dimension.

    The rule is ``constant;factor,factor...;own``: the sum of each number times its
    factor, plus the constant; own = 0 if the factors need the unit of the column.
    """
    text = re.sub(r"\s*/\s*|\s+per\s+", "/", shape.strip().lower())
    if text.upper() in NULL_MARKS or text.upper() in UNTOLD:
        return None
    n_numbers = text.count("#")
    if n_numbers and dimension == "time" and _ISO.fullmatch(text):
        return "0;" + ",".join(repr({"y": 365.25, "m": 30.4375, "w": 7.0, "d": 1.0}[text[i + 1]]) for i, c in enumerate(text) if c == "#") + ";1"
    tokens = _number_words(_TOKEN.findall(text))
    own_vector = DIMENSIONS[dimension]
    values: list[list] = []  # [1 for a number of the text else 0, constant, unit]
    loose: list[float] = []  # units told before or apart from a number
    foreign = False  # a unit of another dimension that stands behind no number
    behind = False  # whether the token before is a number
    for token, value in tokens:
        word = token.strip("./")
        if token == "#":
            values.append([1, 0.0, None])
        elif not math.isnan(value):
            if behind and values[-1][0]:  # 2 and a half years
                values[-1][1] = value
            else:
                values.append([0, value, None])
        elif word not in HEDGES:
            unit = read_unit(token.rstrip("."), dimension)
            if unit is None or unit[0] == own_vector and unit[2] <= LEAST_SCORE:
                pass
            elif unit[0] == own_vector:
                if values and values[-1][2] is None:
                    values[-1][2] = unit[1]
                elif not (values and len(word) < 2):
                    loose.append(unit[1])
            elif behind:
                return None
            else:
                foreign |= len(word) > 1 and unit[0] != DIMENSIONS["count"]
        if token == "#" or not math.isnan(value):
            behind = True
        elif word not in HEDGES:
            behind = False
    if len(values) > 1 and values[-1] == [0, 0.5, None] and values[-2][2] is not None:  # a month and a half
        values[-2][1] += values.pop()[1]
    if n_numbers:
        values = [v for v in values if v[0] or v[2] is not None]  # a number word beside numbers counts only with its unit
    if not values or sum(v[0] for v in values) != n_numbers:
        return None
    if len(values) > 1:
        # Several parts are one quantity only if each has its unit, from large to small.
        units = [v[2] for v in values]
        if None in units or any(a <= b for a, b in zip(units, units[1:], strict=False)):
            return None
    if foreign and not loose and all(v[2] is None for v in values):
        return None
    constant, factors, own = 0.0, [], True
    for is_number, more, unit in values:
        unit = unit if unit is not None else loose[0] if loose else None
        if unit is None:
            own, unit = False, 1.0
        if is_number:
            factors.append(repr(unit))
        constant += more * unit
    return f"{constant!r};{','.join(factors)};{int(own)}"


#: A number: digits with points or commas inside.
_NUMBER = r"\d+(?:[.,]\d+)*|[.,]\d+"
# An exponent behind the sign of a unit isn't a number: it is written as a raised sign first.
_RAISED = r"(?<=[\s\d/](?:[kmcdunpµμ]?[mlgs]|d|day|h|hr|min|[mnpuµμ]?mol))\^?{}(?![\w.,])"
_RAISED_SIGNS = {"2": "²", "3": "³", "-1": "⁻¹", "-2": "⁻²", "-3": "⁻³"}


def _with_raised(text: Column) -> Column:
    out = text
    for plain, raised in _RAISED_SIGNS.items():
        out = F.regexp_replace(out, _RAISED.format(plain), raised)
    return F.when(text.rlike("[a-zµμ][-^]?-?[123]"), out).otherwise(text)  # few values hold such a sign at all


def _plain_number(text: Column) -> Column:
    """A comma before three digits groups thousands; any other is a decimal mark."""
    grouped = F.regexp_replace(text, r",(?=\d{3}(?!\d))", "")
    return F.replace(grouped, F.lit(","), F.lit(".")).try_cast("double")


def column_units(tables: list[tuple[DataFrame, str, str]], cohort: str = "gse_id", dimension: str = "time") -> DataFrame:
    """(cohort_key, column_name, told): the unit told for a cohort's column by unit tables, the first table first.

    Each table is (frame, its column of names, its column of units).  Of several known units
    of one column in one table the one told most often holds, then the larger.
    """
    ship(tables[0][0].sparkSession)

    @F.pandas_udf("double")
    def size_of(units: pd.Series) -> pd.Series:
        return units.map(lambda u: (segment_unit(u, dimension) or (None,))[0] if u is not None else None).astype("float64")

    parts = []
    for rank, (frame, names, units) in enumerate(tables):
        clean = F.when(~F.upper(stripped(F.col(units))).isin(*UNTOLD), F.lower(stripped(F.col(units))))
        parts.append(frame.select(normal_key(F.col(cohort)).alias("cohort_key"), F.col(names).alias("column_name"), clean.alias("unit"), F.lit(rank).alias("rank")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = rows.where("unit is not null and cohort_key is not null and column_name is not null").groupBy("cohort_key", "column_name", "rank", "unit").agg(F.count(F.lit(1)).alias("n"))
    sized = rows.withColumn("size", size_of("unit")).where("size is not null and not isnan(size)")
    sized = sized.groupBy("cohort_key", "column_name", "rank", "size").agg(F.sum("n").alias("n"))
    return sized.groupBy("cohort_key", "column_name").agg(F.min_by("size", F.struct("rank", -F.col("n"), -F.col("size"))).alias("told"))


def in_common_unit(values: DataFrame, tables: list[tuple[DataFrame, str, str]], dimension: str = "time", value: str = "raw_time", name: str = "column_name", cohort: str = "gse_id", row_id: str = "row_id") -> DataFrame:
    """(row_id, amount): every row that holds a quantity of the dimension whose unit is told, in the dimension's base unit.

    The value's own unit goes before those of the unit tables (frame, its column of names,
    its column of units) in their order, and the unit in the column's name comes last.
    Nulls, null marks, words without a number, quantities of another dimension and of
    an untold unit give no row; repeated rows each give theirs.  Values of any length
    are read whole.  The rules of the distinct shapes and names are made once.
    """
    ship(values.sparkSession)
    rows = values.select(F.col(row_id).alias("row_id"), normal_key(F.col(cohort)).alias("cohort_key"), F.col(name).alias("column_name"), F.lower(real_value(F.col(value))).alias("raw")).where("raw is not null")
    # Told to be no nulls: a filter or join would else test them for null first and make them twice.
    rows = rows.withColumn("raw", F.coalesce(_with_raised(F.col("raw")), F.lit("")))
    rows = rows.withColumn("shape", F.coalesce(F.regexp_replace("raw", _NUMBER, "#"), F.lit("")))

    @F.pandas_udf("string")
    def rule_of(texts: pd.Series, is_shape: pd.Series) -> pd.Series:
        out = [shape_rule(t, dimension) if s else unit_of_name(t, dimension) for t, s in zip(texts, is_shape, strict=True)]
        return pd.Series([repr(r) if isinstance(r, float) else r for r in out], dtype="object")

    both = F.array(F.struct(F.lit(True).alias("is_shape"), F.col("shape").alias("text")), F.struct(F.lit(False).alias("is_shape"), F.col("column_name").alias("text")))
    texts = rows.select(F.explode(both).alias("t")).select("t.*").where("text is not null").distinct()
    known = bounded(texts.withColumn("rule", rule_of("text", "is_shape")).where("rule is not null"), BROADCAST_RULES)
    parts = F.split("rule", ";")
    rules = known.where("is_shape").select(
        F.col("text").alias("shape"),
        parts[0].cast("double").alias("constant"),
        F.transform(F.filter(F.split(parts[1], ","), lambda x: x != ""), lambda x: x.cast("double")).alias("factors"),
        (parts[2] == "1").alias("own"),
    )
    named = known.where("not is_shape").select(F.col("text").alias("column_name"), F.col("rule").cast("double").alias("by_name"))
    joined = rows.join(rules, "shape").join(column_units(tables, cohort, dimension), ["cohort_key", "column_name"], "left").join(named, "column_name", "left")
    numbers = F.transform(F.regexp_extract_all("raw", F.lit(f"({_NUMBER})")), _plain_number)
    amount = F.col("constant") + F.aggregate(F.zip_with(numbers, "factors", lambda n, f: n * f), F.lit(0.0), lambda a, b: a + b)
    return joined.select("row_id", (amount * F.when(F.col("own"), 1.0).otherwise(F.coalesce("told", "by_name"))).alias("amount")).where("amount is not null")


def times_in_days(values: DataFrame, survival: DataFrame, numeric: DataFrame, value: str = "raw_time", name: str = "column_name", cohort: str = "gse_id", row_id: str = "row_id") -> DataFrame:
    """(row_id, time_days): every row that holds a time whose unit is told, in whole days (half a day rounds up).

    Units of survival_mapping go before those of numeric_column_unit; see ``in_common_unit``.
    """
    days = in_common_unit(values, [(survival, "time_column", "time_unit"), (numeric, "column_name", "unit")], "time", value, name, cohort, row_id)
    # Float products such as 0.1 * 7 are off by an ulp; a tie at half a day must not hang on that.
    return days.select("row_id", F.floor(F.round("amount", 6) + 0.5).cast("long").alias("time_days"))


def numeric_column_days(values: DataFrame, units: DataFrame, value: str = "raw_time", name: str = "column_name", cohort: str = "gse_id") -> DataFrame:
    """``values`` (one row a value) with derived_name and days, by the plain unit told for the cohort's column.

    days is the value as a number, else its first number, times the unit told in
    ``units`` (cohort, column_name, unit); derived_name is ``llm_<column>_days``.  Rows of
    columns with an unknown unit, or without one, are left out; of several units of a
    column the first in order of the text holds.  The raw value stays.
    """
    factor = F.element_at(F.create_map(*[F.lit(x) for pair in DAYS.items() for x in pair]), F.col("unit"))
    known = units.where(F.col("unit").isin(*DAYS)).groupBy(F.col(cohort).alias("__cohort"), F.col(name).alias("__name")).agg(F.min("unit").alias("unit")).select("__cohort", "__name", factor.alias("__factor"))
    out = values.join(known, (F.col(cohort) == F.col("__cohort")) & (F.col(name) == F.col("__name")))
    return out.select(*values.columns, F.concat(F.lit("llm_"), column_slug(F.col(name)), F.lit("_days")).alias("derived_name"), (leading_number(F.col(value)) * F.col("__factor")).alias("days"))


def with_unit_days(df: DataFrame, units: list[tuple[str, str]]) -> DataFrame:
    """A wide table with a column ``llm_<column>_days`` for each (column, unit) whose unit is known; absent columns are skipped, raw ones stay."""
    new = {f"llm_{re.sub(r'[^0-9A-Za-z]+', '_', c).strip('_').lower()}_days": leading_number(F.col(f"`{c}`")) * F.lit(DAYS[u]) for c, u in units if c in df.columns and u in DAYS}
    return df.withColumns(new) if new else df
