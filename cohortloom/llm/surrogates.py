"""Keyed replacements of personal information: placeholders with a type, or surrogates.

A surrogate depends on a secret key and the entity alone (HMAC), so one entity has
one surrogate in all documents without any exchange between tasks, and a surname
keeps its surrogate with and without a given name.  Surrogates follow their
original in kind, gender of a known given name, case, script, separators, length of
numbers and type of street; of an email the domain is replaced too, alike for all its
addresses.  Where two entities would share a surrogate, or a surrogate is an entity of
the corpus, another is drawn and checked again, until none is left; this runs over
the distinct entities of the whole corpus.
"""

from __future__ import annotations

import hashlib
import hmac
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.pii import _PART, MENS_NAMES, WOMENS_NAMES, fold, find_entities
from cohortloom.session import cut_lineage, ship, spread

SPANS = "array<struct<pii_kind:string,char_from:int,char_to:int,entity:string>>"
# Endings of made given names by gender.
ENDINGS = {"woman": "a ana ela ina ora etta issa ielle".split(), "man": "o an en or us ulf ert ard".split(), "unknown": "is el ey im yn ar on il".split()}
# Sounds of made names in the scripts with syllables: onsets, vowels, codas.
SOUNDS = {
    "Latin": ("b br d dr f g gr h j k kl l m n p pl r s sk st t tr v w z".split(), "a e i o u".split(), "l m n r s t nd rk lt".split()),
    "Cyrillic": ("б бр в г гр д др ж з к кл л м н п пл р с ск ст т тр ф".split(), "а е и о у".split(), "в л м н р с т нов лин".split()),
    "Greek": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ χ στ κρ πλ".split(), "α ε ι ο ου".split(), "ς ν ρος λης κης μος".split()),
}
# Letters of made names in the scripts without; the first row of Han are surnames.
HAN_SURNAMES, HAN_LETTERS = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何高林罗郑梁谢宋唐许韩冯邓曹彭曾萧田董袁潘于蒋蔡余杜叶程苏魏吕丁任沈", "东南西北春秋江山林泉石云松竹梅兰海河湖星明华文英志国建安平宁永晓丽静雪芳"
LETTERS = {
    "Han": HAN_LETTERS, "Hiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねのまみむめもやゆよらりるれろ", "Katakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノマミムメモヤユヨラリルレロ",
    "Hangul": "가나다라마바사아자차카타파하고노도로모보소오조초호구누두루무부수우주기니디리미비시이지", "Arabic": "ابتثجحخدذرزسشصطعغفقكلمنهوي", "Hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
}
# What tells the type of a street or place, and stays.
PLACE_WORDS = frozenset(
    "flat apt apartment unit suite house lodge cottage hall floor box po street st road rd lane ln close crescent cres drive dr blvd boulevard avenue ave court ct place terrace square row mews gardens grove walk way"
    " calle plaza pza avda avenida paseo camino ronda bajo ático entlo rue bd av chemin impasse quai allée cours route passage bis ter quater str straße strasse gasse allee weg ring platz damm ufer".split()
)
STREET_ENDING = r"(?:er[ ])?(?:[Ss]tra(?:ß|ss)e|[Ss]tr\.|gasse|allee|weg|ring|platz|damm|ufer)"
HAN_PLACE_SIGNS = "省市区县镇乡村路街巷弄号栋幢座单元室房楼层大道胡同"
# Codes of states before a number of five digits.
STATES = "AL AZ CA CO CT FL GA IA IL IN KS KY MA MD MI MN MO NC NJ NY OH OR PA SC TN TX UT VA WA WI".split()
#: So many draws of a surrogate before a mark makes it differ.
DRAWS = 8


def _draw(key: bytes, *parts: object) -> int:
    return int.from_bytes(hmac.new(key, "\x1f".join(map(str, parts)).encode(), hashlib.sha256).digest()[:8], "big")


def entity_of(kind: str, text: str) -> str:
    """The form under which mentions are one entity: case, marks, spacing and order of a name don't count."""
    if kind == "name":
        if "," in text:
            last, _, first = text.partition(",")
            text = f"{first} {last}"
        return " ".join(fold(text).split())
    if kind == "email":
        plain = regex.sub(r"\s*[(\[{]?\s*\b(?:at|AT)\b\s*[)\]}]?\s*|\s*@\s*", "@", text, count=1)
        return regex.sub(r"\s*[(\[{]?\s*\b(?:dot|DOT)\b\s*[)\]}]?\s*", ".", plain).lower()
    if kind in ("phone", "id_number"):
        return "".join(c for c in text.translate({0xFF0B: "+"}).upper() if c.isalnum() or c == "+")
    return " ".join(fold(text).replace(",", " ").split())


def placeholder(kind: str, entity: str, key: bytes) -> str:
    """``[NAME_1A2B3C4D5E6F]``: the kind and 48 keyed bits of the entity."""
    return f"[{kind.upper()}_{_draw(key, kind, entity) >> 16:012X}]"


def _cased(model: str, word: str) -> str:
    return word.upper() if len(model) > 1 and model.isupper() else word.lower() if model.islower() else word


def script_of(word: str) -> str:
    """The script of a word's first letter of a known one; Latin for any other."""
    for c in word:
        for script in (*SOUNDS, *LETTERS):
            if regex.match(rf"\p{{{script}}}", c):
                return script
    return "Latin"


def _pick(n: int, table) -> tuple[int, str]:
    n, i = divmod(n, len(table))
    return n, table[i]


def _syllables(n: int, script: str, count: int) -> str:
    out = ""
    for _ in range(count):
        for sounds in SOUNDS[script]:
            n, sound = _pick(n, sounds)
            out += sound
    return out


def _letters(word: str, key: bytes, *salt: object) -> str:
    """A word of a script without syllables: every letter by a keyed one, signs that lengthen or double it included."""
    out = []
    for i, c in enumerate(word):
        table = LETTERS.get(script_of(c)) if c.isalpha() else None
        out.append(table[_draw(key, *salt, word, i) % len(table)] if table else c)
    return "".join(out)


def _surname(word: str, key: bytes, salt: int = 0) -> str:
    script = script_of(word)
    if script in LETTERS:
        out = _letters(word, key, "surname", salt)
        return HAN_SURNAMES[_draw(key, "surname", word, salt) % len(HAN_SURNAMES)] + out[1:] if script == "Han" else out
    ending = "а" if script == "Cyrillic" and word[-1].lower() in "ая" else ""
    return _cased(word, _syllables(_draw(key, "surname", fold(word), salt), script, 2).capitalize() + ending)


def gender_of(given: str) -> str:
    """woman, man, or unknown, by the table of given names."""
    plain = fold(given)
    return "woman" if plain in WOMENS_NAMES else "man" if plain in MENS_NAMES else "unknown"


def _initial(word: str, key: bytes, script: str) -> str:
    """A sound that depends on a name's first letter alone, so that an initial and its name agree."""
    return _pick(_draw(key, "initial", fold(word)[:1]), [s for s in SOUNDS[script][0] if len(s) == 1])[1]


def _given(word: str, key: bytes, salt: int = 0) -> str:
    script = script_of(word)
    if script in LETTERS:
        return _letters(word, key, "given", salt)
    first = _initial(word, key, script).upper()
    if word.endswith("."):
        return _cased(word.rstrip("."), first) + "."
    n, vowel = _pick(_draw(key, "given", fold(word), salt), SOUNDS[script][1])
    n, middle = _pick(n, [s for s in SOUNDS[script][0] if len(s) <= 2])
    if script != "Latin":
        # In these scripts the last letter tells the gender: a vowel stays a vowel.
        ending = word[-1].lower() if word[-1].lower() in "аяηα" else SOUNDS[script][2][n % len(SOUNDS[script][2])]
        return _cased(word, first + vowel + middle + (SOUNDS[script][1][n % len(SOUNDS[script][1])] if len(ending) > 1 else "") + ending)
    _, end = _pick(n, ENDINGS[gender_of(word)])
    return _cased(word, first + vowel + middle + end)


def _shaped(text: str, key: bytes, letters: bool, salt: int = 0) -> str:
    """Every digit (and letter) replaced by a keyed one of its script and case; the rest stays, and so does a zero in front."""
    out, seed, front = [], entity_of("id_number", text), True
    for i, c in enumerate(text):
        n = _draw(key, "char", seed, i, salt)
        if c.isdecimal():
            zero = ord(c) - int(c)
            out.append(c if front and c == chr(zero) else chr(zero + (n % 9 + 1 if front else n % 10)))
            front = False
        elif letters and "a" <= c.lower() <= "z":
            out.append(chr(ord("A" if c.isupper() else "a") + n % 26))
        elif letters and c.isalpha():
            out.append(_letters(c, key, seed, i, salt) if script_of(c) in LETTERS else _cased(c, SOUNDS[script_of(c)][1][n % 5][0]))
        else:
            out.append(c)
    return "".join(out)


def _name(text: str, key: bytes, salt: int) -> str:
    if regex.fullmatch(r"\p{Han}{2,4}", text):
        return _surname(text[0], key, salt) + _given(text[1:], key, salt)
    words = regex.split(r"([\s,·]+|(?<=\p{L})-(?=\p{L}))", text)
    real = [i for i in range(0, len(words), 2) if words[i] and not regex.fullmatch(_PART, words[i])]
    firsts = set(real[1:]) if "," in text else set(real[:-1])
    if "," not in text and len(real) > 1 and words[real[-1] - 1] == "-":
        firsts.discard(real[-2])
    for i in real:
        words[i] = _given(words[i], key, salt) if i in firsts or words[i].endswith(".") else _surname(words[i], key, salt)
    return "".join(words)


def _email(text: str, key: bytes, salt: int) -> str:
    """The part before the at shaped as it is; each label of the domain but the last by a made one, alike for all addresses of a domain."""
    at = regex.search(r"[ ]?@[ ]?|[ ]?[(\[{]\s?(?:at|AT|At)\s?[)\]}][ ]?|[ ](?:at|AT)[ ]", text)
    head, tail = (text[: at.start()], text[at.end() :]) if at else (text, "")
    words = regex.split(r"([^\p{L}\p{N}]+)", head)
    local = "".join(_shaped(w, key, True, salt) if i % 2 == 0 else w for i, w in enumerate(words))
    labels = regex.split(r"(\.|[ ]?[(\[{]\s?(?:dot|DOT|Dot|punkt|punto|point)\s?[)\]}][ ]?|[ ](?:dot|DOT)[ ])", tail)
    for i in range(0, len(labels) - 1, 2):
        labels[i] = _cased(labels[i], _syllables(_draw(key, "domain", fold(labels[i])), "Latin", 1 + (len(labels[i]) > 4)))
    return local + (at[0] if at else "") + "".join(labels)


def _address(text: str, key: bytes, salt: int) -> str:
    """Numbers, names and codes replaced; the type of the street, small words and signs stay."""

    def word(m) -> str:
        text = m[0]
        if fold(text).rstrip(".") in PLACE_WORDS or text.rstrip(".").lower() in PLACE_WORDS:
            return text
        if regex.fullmatch(r"\p{Lu}\.", text):
            return text
        if regex.fullmatch(r"\p{Lu}{1,2}", text):
            return text if len(text) == 1 else STATES[_draw(key, "state", text, salt) % len(STATES)]
        ending = regex.search(rf"{STREET_ENDING}$", text)
        if ending and ending.start():
            return _surname(text[: ending.start()], key, salt) + ending[0]
        return _surname(text, key, salt) if text[0].isupper() else text

    out = regex.sub(r"(?<![\p{L}\d])[A-Z]{1,2}\d[A-Z\d]?[ ]?\d[A-Z]{2}(?![\p{L}\d])", lambda m: "\x02" + _shaped(m[0], key, True, salt) + "\x02", text)
    parts = out.split("\x02")  # codes with letters stand at the odd places and are done
    for i in range(0, len(parts), 2):
        plain = regex.sub(r"\d+", lambda m: _shaped(m[0], key, False, salt), parts[i])
        plain = regex.sub(r"\p{Han}+", lambda m: "".join(c if c in HAN_PLACE_SIGNS else HAN_LETTERS[_draw(key, "han", m[0], j, salt) % len(HAN_LETTERS)] for j, c in enumerate(m[0])), plain)
        parts[i] = regex.sub(r"[^\W\d_\p{Han}](?:[^\W\d_\p{Han}]|['’\-](?=\p{L}))*\.?", word, plain)
    return "".join(parts)


def surrogate(kind: str, text: str, key: bytes, draw: int = 0) -> str:
    """The surrogate of one mention; ``draw`` counts the earlier ones that another entity had, from ``DRAWS`` on a mark tells them apart."""
    salt = min(draw, DRAWS)
    if kind == "name":
        out = _name(text, key, salt)
    elif kind == "email":
        out = _email(text, key, salt)
    elif kind == "phone":
        code = regex.match(r"\(?(?:[+＋]|00)\d{1,3}\)?", text)
        keep = code.end() if code else 0
        out = text[:keep] + _shaped(text[keep:], key, False, salt)
    elif kind == "id_number":
        out = _shaped(text, key, True, salt)
    else:
        out = _address(text, key, salt)
    if draw > DRAWS:
        n, mark = _draw(key, "mark", kind, entity_of(kind, text), draw), ""
        for _ in range(draw - DRAWS + 1):
            n, d = divmod(n, 26)
            mark += chr(97 + d)
        out = f"{out}-{mark}" if kind != "email" else regex.sub(r"^[^\s@(\[{]+", lambda m: f"{m[0]}-{mark}", out)
    return out


def detected(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text, spans) of every document."""
    ship(documents.sparkSession)

    @F.pandas_udf(SPANS)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: [{"pii_kind": k, "char_from": a, "char_to": b, "entity": entity_of(k, t[a:b])} for k, a, b in find_entities(t)])

    return spread(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).withColumn("spans", spans("text"))


def entity_places(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, pii_kind, char_from, char_to): one row per mention; places in code points.

    Null, empty and blank texts have none; repeated documents each give theirs;
    texts of any length are read whole.  A map without a shuffle where there are files enough.
    """
    return detected(documents, text, doc_id).select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.pii_kind", "s.char_from", "s.char_to")


def _rewrite(text: str, spans: list, of) -> str:
    out, at = [], 0
    for s in spans:
        out += [text[at : s["char_from"]], of(s["pii_kind"], text[s["char_from"] : s["char_to"]], s["entity"])]
        at = s["char_to"]
    return "".join([*out, text[at:]])


def with_placeholders(documents: DataFrame, key: str) -> DataFrame:
    """(doc_id, text, n_entities): the texts with typed placeholders; a null text stays null."""
    ship(documents.sparkSession)
    secret = key.encode()

    @F.pandas_udf("struct<text:string,n_entities:int>")
    def masked(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            found = [{"pii_kind": k, "char_from": a, "char_to": b, "entity": entity_of(k, t[a:b])} for k, a, b in find_entities(t)]
            rows.append((t if t is None else _rewrite(t, found, lambda k, _, e: placeholder(k, e, secret)), len(found)))
        return pd.DataFrame(rows, columns=["text", "n_entities"])

    return spread(documents.select("doc_id", "text")).select("doc_id", masked("text").alias("m")).select("doc_id", "m.*")


def draws_of(found: DataFrame, key: str) -> DataFrame:
    """(pii_kind, entity, draw): which draw of its surrogate each entity has, so that no two share one and none is an entity of the corpus.

    In each round the entities whose surrogate another one holds, all but the first, and
    those whose surrogate is a real entity draw again; what is settled stays.  A round's
    table has a row an entity and is written.
    """
    secret = key.encode()

    @F.pandas_udf("string")
    def drawn(kinds: pd.Series, mentions: pd.Series, draws: pd.Series) -> pd.Series:
        return pd.Series([entity_of(k, surrogate(k, m, secret, d)) for k, m, d in zip(kinds, mentions, draws, strict=True)], dtype="object")

    mention = F.substring(F.col("text"), F.col("s.char_from") + 1, F.col("s.char_to") - F.col("s.char_from"))
    mentions = found.select("text", F.explode("spans").alias("s")).select("s.pii_kind", "s.entity", mention.alias("mention"))
    current = cut_lineage(mentions.groupBy("pii_kind", "entity").agg(F.min("mention").alias("mention")).withColumn("draw", F.lit(0)))
    real = current.select("pii_kind", F.col("entity").alias("told"), F.lit(True).alias("is_real"))
    first = Window.partitionBy("pii_kind", "told").orderBy("draw", "entity")
    while True:
        tried = current.withColumn("told", drawn("pii_kind", "mention", "draw")).join(real, ["pii_kind", "told"], "left")
        again = tried.withColumn("again", F.coalesce("is_real", F.lit(False)) | (F.row_number().over(first) > 1))
        after = cut_lineage(again.select("pii_kind", "entity", "mention", (F.col("draw") + F.col("again").cast("int")).alias("draw"), "again"))
        current = after.drop("again")
        if after.where("again").isEmpty():
            return current.select("pii_kind", "entity", "draw")


def with_surrogates(documents: DataFrame, key: str) -> DataFrame:
    """(doc_id, text): the texts with surrogates; detection runs once and is written.

    A null text stays null; repeated documents each give theirs.
    """
    secret = key.encode()
    found = cut_lineage(detected(documents))
    drawn_again = draws_of(found, key).where("draw > 0")
    held = found.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.pii_kind", "s.entity").distinct()
    by_doc = held.join(drawn_again, ["pii_kind", "entity"]).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x1f", "pii_kind", "entity"), "draw"))).alias("draws"))

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, spans: pd.Series, draws: pd.Series) -> pd.Series:
        out = []
        for t, s, d in zip(texts, spans, draws, strict=True):
            d = dict(d) if d is not None else {}
            out.append(t if t is None else _rewrite(t, list(s), lambda k, m, e, d=d: surrogate(k, m, secret, d.get(f"{k}\x1f{e}", 0))))
        return pd.Series(out, dtype="object")

    return found.join(by_doc, "doc_id", "left").select("doc_id", replaced("text", "spans", "draws").alias("text"))
