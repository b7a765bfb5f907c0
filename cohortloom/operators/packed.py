"""Several values packed in one cell, split by rules resolved per delimiter skeleton.

A cell's skeleton is the cell with its ordinary characters masked: a quoted part, a
code (a word with a digit), a null mark, another word and a phrase of several words
each become one sign, and what repeats is kept once, so that millions of cells share a
few thousand skeletons.  For each distinct skeleton it is resolved once which of its
separators cut the cell and which belong to a value; the rules are joined back
(broadcast only while their number is below a checked bound), and the cell is cut by
its rule outside quotes, with the place of each piece.

How a skeleton resolves its separators:

* Cells of codes and words are lists: every separator cuts, also several kinds in one cell.
* In a cell with a phrase ("kinase, alpha chain; box 2") only the strongest separator
  cuts; weaker ones belong to the phrases.
* A nested record is cut at the separator that stands behind its first piece (the
  accession); the other piece separators belong to a value.  A record of more than five
  pieces has them in its description, which takes the surplus.
* A line break starts a record only where a code or null mark follows; any other is a
  wrapped text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.keys import NULL_MARKS, real_value
from cohortloom.session import bounded, ship

# Separators of values in a cell, the strongest first, as regular expressions by name.
SEPARATORS = {"triple": r"///", "line": r"\r?\n", "tab": r"\t", "bar": r"\|", "semi": r";", "double": r"//", "slash": r"(?<![^ ])/(?![^ ])", "comma": r","}
# Separators of records, and of the pieces of a record.
RECORD_SEPARATORS = {"triple": r"(?:\r?\n)?[ \t]*///[ ]*(?:\r?\n)?", "line": r"\r?\n"}
PIECE_SEPARATORS = {"double": r"//", "tab": r"\t", "bar": r"\|"}
#: Pieces of a record, and the place of the one that takes surplus pieces.
RECORD_PIECES, FREE_TEXT_PIECE = 5, 3

#: Beyond so many distinct skeletons their rules are shuffled, not broadcast.
BROADCAST_RULES = 200_000

_PIECES = "array<struct<slot_no:int,piece_no:int,item:string>>"
#: Signs of a skeleton: quoted part, code, null mark, word, phrase; while masking they are private characters.
_SIGNS, _MASKS = "QC-xw", "\ue000\ue001\ue002\ue003\ue004"
_UNIT, _RECORD, _BREAK, _END = "\x1f", "\x1e", "\x1d", "\x03"
_QUOTED = r"(?<![^\s/;,|])(?:\"[^\"]*+(?:\"\"[^\"]*+)*+\"|'[^'\n]*+(?:''[^'\n]*+)*+')(?=[\s/;,|]|$)"


def with_skeleton(df: DataFrame, cell: str = "cell", nested: str = "nested") -> DataFrame:
    """``df`` with the skeleton of a cell: its distinct units in order, pieces with their separator, or the records of a nested field.

    The steps are columns of their own, as each is used several times by the next; the costly
    patterns run only on cells that hold one of their signs.
    """
    quote, code, null, word, phrase = _MASKS
    text = F.col(cell)
    df = df.withColumn("__q", F.when(text.contains('"') | text.contains("'"), F.regexp_replace(text, _QUOTED, quote)).otherwise(text))
    df = df.withColumn("__n", F.when(F.col("__q").rlike("---|[nN][oO][nN][eE]"), F.regexp_replace("__q", r"(?i)(?<![^\s/;,|])(?:---|none)(?![^\s/;,|])", null)).otherwise(F.col("__q")))
    masked = F.regexp_replace("__n", rf"[^\s/;,|{_MASKS}0-9]*+[0-9][^\s/;,|{_MASKS}]*+", code)
    masked = F.regexp_replace(masked, rf"[^\s/;,|{_MASKS}]++", word)
    df = df.withColumn("__m", F.regexp_replace(masked, rf"[{code}{word}]++(?: ++[{code}{word}]++)++", phrase))
    units = F.regexp_extract_all(F.concat("__m", F.lit(_END)), F.lit(rf"[^/;,|\t\n{_END}]*+(?:///|//|/[ {_END}]?|[;,|\t\n{_END}])"), F.lit(0))
    records = F.regexp_replace(F.regexp_replace("__m", RECORD_SEPARATORS["triple"], _RECORD), rf"\r?\n(?=\s*(?:[{quote}{code}{null}{_RECORD}]|$))", _BREAK + _RECORD)
    out = F.array_join(F.array_distinct(F.when(F.col(nested), F.split(records, _RECORD)).otherwise(units)), _UNIT)
    # A cell without separators and quotes is one piece, whatever it holds.
    out = F.when(text.rlike("[/;,|\t\r\n\"']"), F.translate(out, _MASKS, _SIGNS)).otherwise("x")
    # Told to be no null: a join on it would else test it for null first and make it twice.
    return df.withColumn("skeleton", F.coalesce(out, F.lit("x"))).drop("__q", "__n", "__m")


def list_rule(skeleton_text: str) -> str:
    """Names of the separators that cut a cell of this skeleton, '|'-joined; 'none' without any."""
    units = [u.rstrip(_END) if u.endswith(_END) and not u.endswith("/" + _END) else u for u in skeleton_text.split(_UNIT)]
    found = set()
    for unit in units:
        end = re.search(r"(///|//|(?:(?<=^)|(?<= ))/[ \x03]|[;,|\t\n])$", unit)
        if end:
            sign = end[1]
            found.add({"///": "triple", "//": "double", ";": "semi", ",": "comma", "|": "bar", "\t": "tab", "\n": "line"}.get(sign, "slash"))
    ordered = [name for name in SEPARATORS if name in found]
    if len(ordered) > 1 and any("w" in u for u in units):
        ordered = ordered[:1]
    return "|".join(ordered) or "none"


def record_rule(skeleton_text: str) -> str:
    """``records:pieces:surplus``: the record separators that cut, the piece separators that stand behind a first piece, and 1 if a record has too many pieces."""
    kinds: set[str] = set()
    surplus = breaks = wrapped = False
    for record in skeleton_text.split(_UNIT):
        breaks |= record.endswith(_BREAK)
        wrapped |= "\n" in record
        first = re.search("|".join(f"(?P<{n}>{p})" for n, p in PIECE_SEPARATORS.items()), record)
        if first:
            kinds.add(first.lastgroup)
            surplus |= len(re.findall(PIECE_SEPARATORS[first.lastgroup], record)) >= RECORD_PIECES
    records = ["triple", *(["coded_line"] if breaks and wrapped else ["line"] if breaks else [])]
    return f"{'|'.join(records)}:{'|'.join(n for n in PIECE_SEPARATORS if n in kinds) or 'none'}:{int(surplus)}"


def _unquoted(piece: str) -> str:
    piece = piece.strip()
    if len(piece) > 1 and piece[0] == piece[-1] and piece[0] in "\"'":
        return piece[1:-1].replace(piece[0] * 2, piece[0]).strip()
    return piece


#: A quoted part in Python's dialect: bounded by blanks or separators of any kind, cutting or not.
_OPEN = re.compile(r"(?<![^\s/;,|])(?:\"(?:[^\"]|\"\")*\"|'(?:[^'\n]|'')*')(?=[\s/;,|]|\Z)").pattern


def _scanner(table: dict[str, str]) -> re.Pattern:
    any_of = "|".join(f"(?P<{n}>{p})" for n, p in table.items())
    return re.compile(rf"(?P<open>{_OPEN})|{any_of}") if any_of else re.compile(r"(?!)")


def _list_cuts(rule: str) -> dict[str, str]:
    """The separators of a rule, longer ones before those they hold."""
    names = [] if rule == "none" else rule.split("|")
    return {n: SEPARATORS[n] for n in ("triple", "double", "line", "tab", "bar", "semi", "slash", "comma") if n in names}


def cut_list(cell: str, rule: str, scanners: dict) -> list[dict]:
    """The values of a list cell under its rule; only real ones, with their place among all."""
    if rule not in scanners:
        scanners[rule] = _scanner(_list_cuts(rule))
    out, slot, begin = [], 1, 0
    for m in scanners[rule].finditer(cell):
        if m.lastgroup != "open":
            _keep(out, cell[begin : m.start()], slot, 1)
            slot, begin = slot + 1, m.end()
    _keep(out, cell[begin:], slot, 1)
    return out


def _keep(out: list[dict], text: str, slot: int, piece: int) -> None:
    item = _unquoted(text)
    if item.upper() not in NULL_MARKS:
        out.append({"slot_no": slot, "piece_no": piece, "item": item})


def cut_records(cell: str, rule: str, scanners: dict) -> list[dict]:
    """The pieces of a nested cell under its rule: records at the record separators, each cut by its own first piece separator."""
    records, pieces, surplus = rule.split(":")
    if rule not in scanners:
        breaks = {"line": r"\r?\n", "coded_line": r"\r?\n(?=\s*(?:[\"']|[^\s/|]*\d[^\s/|]*\s*(?://|\t|\||\r?\n|\Z)|---|(?i:none)\b|///|\Z))"}
        table = {"triple": RECORD_SEPARATORS["triple"]} | {n: breaks[n] for n in records.split("|") if n in breaks}
        scanners[rule] = _scanner(table | {n: PIECE_SEPARATORS[n] for n in pieces.split("|") if n in PIECE_SEPARATORS})
    out: list[dict] = []
    slot, kind, places = 1, None, [0]

    def close(end: int) -> None:
        starts, ends = places[::2], [*places[1::2], end]
        texts = [cell[a:b] for a, b in zip(starts, ends, strict=True)]
        if surplus == "1" and len(texts) > RECORD_PIECES:
            # The pieces behind the description stand at the end, if it ends with a number or null mark.
            behind = RECORD_PIECES - FREE_TEXT_PIECE if re.fullmatch(r"\s*[\"']?(?:\d+|---|none|)[\"']?\s*", texts[-1], re.IGNORECASE) else 0
            last = len(texts) - behind - 1
            texts = texts[: FREE_TEXT_PIECE - 1] + [cell[starts[FREE_TEXT_PIECE - 1] : ends[last]]] + texts[last + 1 :]
        for piece, text in enumerate(texts, 1):
            _keep(out, text, slot, piece)

    for m in scanners[rule].finditer(cell):
        name = m.lastgroup
        if name == "open":
            continue
        if name in PIECE_SEPARATORS:
            kind = kind or name
            if name == kind:
                places += [m.start(), m.end()]
        else:
            close(m.start())
            slot, kind, places = slot + 1, None, [m.end()]
    close(len(cell))
    return out


def cut_cell(cell: str, rule: str, nested: bool, scanners: dict) -> list[dict]:
    """The pieces of one cell under its rule: slot_no, piece_no, item; only real values."""
    return cut_records(cell, rule, scanners) if nested else cut_list(cell, rule, scanners)


def split_packed(df: DataFrame, fields: list[str], nested: tuple[str, ...] = (), row_id: str = "row_id") -> DataFrame:
    """One row per real value of the packed ``fields``: row_id, src_field, slot_no, piece_no, item.

    slot_no counts the values of a cell from 1, empty ones and null marks included;
    in a ``nested`` field a slot is a record and piece_no its piece, elsewhere
    piece_no is 1.  Quoted text isn't split and loses its quotes (doubled quotes
    become one).  Null and blank cells and null marks give no rows; repeated rows
    each give theirs; cells of any length have a skeleton and are cut whole.  Other
    columns aren't read.  The rules of the distinct skeletons are made once.
    """
    ship(df.sparkSession)
    cells = df.select(
        F.col(row_id).alias("row_id"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("src_field"), F.regexp_replace(F.col(f), r"^ +| +$", "").alias("cell")) for f in fields])).alias("c"),
    ).select("row_id", "c.*").where(real_value(F.col("cell")).isNotNull())
    cells = cells.withColumn("nested", F.col("src_field").isin(*nested) if nested else F.lit(False))
    cells = with_skeleton(cells)

    @F.pandas_udf("string")
    def resolve(skeletons: pd.Series, is_nested: pd.Series) -> pd.Series:
        return pd.Series([record_rule(s) if n else list_rule(s) for s, n in zip(skeletons, is_nested, strict=True)], dtype="object")

    rules = bounded(cells.select("skeleton", "nested").distinct().withColumn("rule", resolve("skeleton", "nested")), BROADCAST_RULES)

    @F.pandas_udf(_PIECES)
    def cut(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        scanners: dict = {}
        for texts, rule, is_nested in parts:
            yield pd.Series([None if t is None else cut_cell(t, r, bool(k), scanners) for t, r, k in zip(texts, rule, is_nested, strict=True)])

    # A cell without separators and quotes is its own value: no Python for it.
    plain = (F.col("rule") == "none") & ~F.col("cell").rlike("[\"']")
    one = F.array(F.struct(F.lit(1).alias("slot_no"), F.lit(1).alias("piece_no"), F.trim("cell").alias("item")))
    ruled = cells.join(rules, ["skeleton", "nested"]).withColumn("cuts", cut(F.when(~plain, F.col("cell")), F.col("rule"), F.col("nested")))
    return ruled.select("row_id", "src_field", F.explode(F.coalesce("cuts", one)).alias("p")).select("row_id", "src_field", "p.*")
