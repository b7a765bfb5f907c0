"""Freely typed values mapped to the closest entry of a reference list.

Reference entries, their aliases and the usual short forms of their words are
paths of a trie.  A Levenshtein automaton (with swaps of neighbours) runs over the
trie and returns every entry within a distance that depends on its length.
White space and signs are left out of both sides, so a typo across a word
boundary costs no more than one inside a word.  Combinations of known parts
that the list doesn't hold ("another site or type") are paths as well, without an
entry: a value nearer to such a path than to any entry is unmatched.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate, product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.keys import real_value
from cohortloom.session import ship

# Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans("аеорсухіѕјкмтвнԁɡαορν", "aeopcyxisjkmtbhdgaopv")
# Short and British forms of words of the reference lists.
SHORT_FORMS = {
    "carcinoma": ["carc", "ca"], "adenocarcinoma": ["adenoca", "adenocarc"], "tumor": ["tumour", "tum", "tu"], "lymphoma": ["lymph", "lym"],
    "leukemia": ["leukaemia", "leuk"], "anemia": ["anaemia"], "squamous": ["squam", "sq"], "neuroendocrine": ["neuroend", "ne"], "pancreatic": ["panc"],
    "pulmonary": ["pulm"], "bladder": ["bladd"], "esophageal": ["oesophageal", "oesoph", "esoph"], "esophagus": ["oesophagus"], "gland": ["gl"],
    "aspirate": ["asp"], "peripheral": ["periph"], "prostatic": ["prost"], "hepatic": ["hep"], "mucinous": ["muc"], "papillary": ["pap"], "melanoma": ["mel"],
    "sarcoma": ["sarc"], "cerebrospinal": ["cerebrosp"], "leiomyosarcoma": ["leiomyo"], "mesothelioma": ["meso"],
}
# Words that say something about a sample and nothing about which entry is meant.
REMARKS = set(
    "dx diagnosis diag pat patient pt with primary prim metastatic metastasis mets recurrent drug rx treated treatment single agent tissue source site human snap fresh frozen"
    " biopsy proven see report relapse relapsed stage grade gr nos ffpe left right oral iv mono monotherapy therapy cycle mg kg g ml mcg q3w q2w q4w weekly daily bid sample specimen"
    " suspected probable possible confirmed known of the a type from in at for day dose rep replicate no nr".split()
)
_REMARKS_BY_LENGTH: dict[int, list[str]] = defaultdict(list)
for _r in sorted(REMARKS):
    if len(_r) >= 3:
        _REMARKS_BY_LENGTH[len(_r)].append(_r)
_COUNTED = re.compile(r"\w*\d\w*|[ivx]+[abc]?")
#: Largest number of edits by length of the reference form.
EDITS = ((3, 0), (5, 1), (10, 2), (14, 3))
MOST_EDITS = 4


def allowed_edits(length: int) -> int:
    return next((k for top, k in EDITS if length <= top), MOST_EDITS)


def tokens_of(text: str) -> list[str]:
    """Lower-case words of a value in Latin letters, with ',' and '(' kept as marks of a turned order."""
    text = unicodedata.normalize("NFKC", text).lower().translate(LOOKALIKES)
    text = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")
    text = re.sub(r"adeno[-\s]ca\b", "adenoca", text)
    return re.findall(r"[a-z0-9]+|[,(]", text)


def _squeezed(words: list[str]) -> str:
    return "".join(w for w in words if w not in (",", "("))


class Reference:
    """One concept's reference list as a trie, with the search over it."""

    def __init__(self, entries: list[tuple[int, str, list[str]]]):
        self.forms: dict[str, set[int]] = defaultdict(set)
        self.codes: dict[str, set[int]] = defaultdict(set)
        for ref, name, aliases in entries:
            self._add(ref, name)
            for alias in aliases:
                if alias.upper() == alias or any(c.isdigit() for c in alias):
                    self.codes[_squeezed(tokens_of(alias))].add(ref)  # a code with one other sign is another code
                else:
                    self._add(ref, alias)
        for name in self._absent([name for _, name, _ in entries]):
            self._add(0, name)
        self.trie = _Node()
        for form in self.forms:
            node = self.trie
            node.span(len(form))
            for depth, ch in enumerate(form, 1):
                node = node.children.setdefault(ch, _Node())
                node.span(len(form) - depth)
            node.form = form
        self.vocabulary = {w for _, name, _ in entries for w in tokens_of(name)}
        #: No longer text has a form or code within the edits, a plural s, and the words that a turned order leaves out ("of", "type").
        self.most_signs = max([self.trie.longest, *map(len, self.codes)]) + MOST_EDITS + 1 + 8
        self._near: dict[tuple[str, int], dict[str, int]] = {}
        self._remarks: dict[str, bool] = {}

    def _add(self, ref: int, name: str) -> None:
        words = tokens_of(name)
        for choice in product(*[[w, *SHORT_FORMS.get(w, ())] for w in words]):
            if ref or "".join(choice) not in self.forms:
                form = "".join(choice)
                if ref:
                    self.forms[form].discard(0)
                self.forms[form].add(ref)

    @staticmethod
    def _absent(names: list[str]) -> list[str]:
        """Combinations of a first and a last part that each occur in at least three entries, and not together."""
        firsts, lasts = defaultdict(set), defaultdict(set)
        for name in names:
            words = name.split()
            for cut in range(1, len(words)):
                firsts[" ".join(words[:cut])].add(" ".join(words[cut:]))
        for first, rest in firsts.items():
            for last in rest:
                lasts[last].add(first)
        good_first = {f for f, rest in firsts.items() if len(rest) >= 3 and any(len(lasts[r]) >= 3 for r in rest)}
        good_last = {r for r, fs in lasts.items() if len(fs & good_first) >= 3}
        # The longest common head alone ("carcinoma") pairs with any first part; only whole types count.
        good_first = {f for f in good_first if len(firsts[f] & good_last) >= 3}
        heads = {w.split()[-1] for w in good_last if " " in w}
        whole = {r for r in good_last if " " in r or r not in heads}
        known = set(names)
        return [f"{f} {r}" for f in sorted(good_first) for r in sorted(whole) if f"{f} {r}" not in known]

    def within(self, text: str, most: int) -> dict[str, int]:
        """Every form within ``most`` edits of a text with its distance (insert, delete, replace, swap of neighbours).

        The automaton's state is a row of distances; a branch whose forms are all too short or too
        long for what is left of the text, or whose row is above ``most``, isn't entered.
        """
        found: dict[str, int] = {}
        width, far = len(text), most + 1
        # (node, row, row before, sign that led to the node, depth): a stack, as forms may be longer than the interpreter recurses
        stack = [(self.trie, list(range(width + 1)), None, "", 0)]
        while stack:
            node, row, above, last, depth = stack.pop()
            if node.form is not None and row[width] <= most:
                found[node.form] = row[width]
            depth += 1
            low, high = max(1, depth - most), min(width, depth + most)
            for ch, child in node.children.items():
                # The best place in the text leaves as many signs as some form below has.
                if width - depth - child.longest > most or depth + child.shortest - width > most:
                    continue
                new = [far] * (width + 1)
                least = far
                if depth <= most:
                    new[0] = least = depth
                for i in range(low, high + 1):
                    t = text[i - 1]
                    if t == ch:
                        v = row[i - 1]
                    else:
                        v = row[i - 1]
                        if row[i] < v:
                            v = row[i]
                        if new[i - 1] < v:
                            v = new[i - 1]
                        v += 1
                    if above is not None and t == last and i > 1 and text[i - 2] == ch and above[i - 2] + 1 < v:
                        v = above[i - 2] + 1
                    new[i] = v
                    if v < least:
                        least = v
                if least <= most:
                    stack.append((child, new, row, ch, depth))
        return found

    def best(self, text: str, most: int = MOST_EDITS) -> tuple[int, dict[int, int]]:
        """(distance, entries at it): the nearest entries within the distance their length allows, and within ``most``."""
        if text in self.codes:
            return 0, {r: 0 for r in self.codes[text]}
        if text in self.forms:
            return 0, {r: 0 for r in self.forms[text]}
        most = min(most, allowed_edits(len(text) + MOST_EDITS))
        # No form is nearer than the difference of lengths: a text far longer than all forms isn't searched.
        if most < 1 or len(text) - self.trie.longest > most:
            return MOST_EDITS + 1, {}
        if (text, most) not in self._near:
            self._near[(text, most)] = {f: d for f, d in self.within(text, most).items() if d <= allowed_edits(len(f))}
        near = self._near[(text, most)]
        if not near:
            return MOST_EDITS + 1, {}
        least = min(near.values())
        return least, {r: least for f, d in near.items() if d == least for r in self.forms[f]}

    def _remark(self, word: str) -> bool:
        if word not in self._remarks:
            self._remarks[word] = word in REMARKS or bool(_COUNTED.fullmatch(word)) or word not in self.vocabulary and _like_a_remark(word)
        return self._remarks[word]

    def candidates(self, text: str) -> Iterator[tuple[int, str]]:
        """Readings of a value with the number of words left out: whole, without remarks at the ends, with its order turned back."""
        words = tokens_of(text)
        plain = [w for w in words if w not in (",", "(")]
        if not plain:
            return
        seen: set[str] = set()
        heads = 0
        while heads < len(plain) - 1 and self._remark(plain[heads]):
            heads += 1
        tails = 0
        while tails < len(plain) - 1 and self._remark(plain[-1 - tails]):
            tails += 1
        # Only windows of words that a form or code can match in length are read, so their number grows with the words and not their square.
        place = [i for i, w in enumerate(words) if w not in (",", "(")]
        ends = list(accumulate(map(len, plain), initial=0))
        windows = []
        for h in range(heads + 1):
            last = min(len(plain), bisect_right(ends, ends[h] + self.most_signs) - 1)
            windows += [(h, last - i) for i in range(last - max(h + 1, len(plain) - tails) + 1)]
        for h, end in sorted(windows, key=lambda w: (w[0] + len(plain) - w[1], w)):
            kept = words[place[h] : place[end - 1] + 1]
            orders = [kept]
            for i, w in enumerate(kept):
                if w in (",", "(") and 0 < i < len(kept) - 1:
                    orders.append(kept[i + 1 :] + kept[:i])
                if len(w) <= 3 and 0 < i < len(kept) - 1 and _edits(w, "of") <= 1:
                    orders.append(kept[i + 1 :] + kept[:i])
                    if _edits(kept[-1], "type") <= 1:
                        orders.append(kept[i + 1 : -1] + kept[:i])
            for order in orders:
                reading = _squeezed(order)
                if reading and reading not in seen:
                    seen.add(reading)
                    yield h + len(plain) - end, reading

    def forget(self) -> None:
        """Drop what was kept of earlier searches, so that a long-lived worker doesn't grow."""
        self._near.clear()
        self._remarks.clear()

    def match(self, text: str) -> int:
        """The entry meant by a value, or 0.

        Of all readings the one with the fewest edits counts, then the one that leaves
        out the fewest words.  A plural s costs nothing.  Readings of equal rank with
        several entries mean none for certain: 0.
        """
        top, refs = (float("inf"), 0), set()
        for left_out, reading in self.candidates(text):
            for form, plural in ((reading, 0.0),) + (((reading[:-1], 0.1),) if reading.endswith("s") and len(reading) > 5 else ()):
                # Readings come by words left out: a later one must be nearer, one of the same rank as near.
                bound = top[0] - plural
                most = MOST_EDITS if bound > MOST_EDITS else int(bound) if left_out == top[1] or bound != int(bound) else int(bound) - 1
                if most < 0:
                    continue
                distance, found = self.best(form, most)
                rank = (distance + plural, left_out)
                if found and rank < top:
                    top, refs = rank, set(found)
                elif found and rank == top:
                    refs |= set(found)
        return refs.pop() if len(refs) == 1 else 0


class _Node:
    """A place of the trie: what follows, the form that ends here, and how many signs the forms below still have."""

    __slots__ = ("children", "form", "longest", "shortest")

    def __init__(self) -> None:
        self.children: dict[str, _Node] = {}
        self.form: str | None = None
        self.shortest, self.longest = 1 << 30, -1

    def span(self, left: int) -> None:
        self.shortest, self.longest = min(self.shortest, left), max(self.longest, left)


def _edits(a: str, b: str) -> int:
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            v = min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1)
            if before is not None and j > 1 and i > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            new.append(v)
        before, row = row, new
    return row[-1]


def _like_a_remark(word: str) -> bool:
    """A remark with a typo: one edit, two in long words; only remarks of nearly the same length are compared."""
    near = (r for n in (len(word) - 1, len(word), len(word) + 1) for r in _REMARKS_BY_LENGTH.get(n, ()))
    return any(_edits(word, r) <= (1 if len(r) < 9 else 2) for r in near)


def reference_lists(reference: DataFrame, limit: int = 100_000) -> dict[str, list[tuple[int, str, list[str]]]]:
    """The reference list by concept, on the driver; more than ``limit`` entries are refused."""
    rows = reference.where("canonical_value is not null").select("ref_id", "concept", "canonical_value", "aliases").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"the reference list has more than {limit} entries")
    lists: dict[str, list] = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["ref_id"]):
        lists[r["concept"]].append((r["ref_id"], r["canonical_value"], [a for a in (r["aliases"] or []) if a]))
    return dict(lists)


#: Tries of a worker process by the reference list they were made of; another list drops them.
_TRIES: dict[int, dict[str, Reference]] = {}


def _tries(lists: dict[str, list[tuple[int, str, list[str]]]]) -> dict[str, Reference]:
    key = hash(repr(sorted(lists.items(), key=repr)))
    if key not in _TRIES:
        _TRIES.clear()
        _TRIES[key] = {concept: Reference(entries) for concept, entries in lists.items()}
    for trie in _TRIES[key].values():
        trie.forget()
    return _TRIES[key]


def map_values(values: DataFrame, reference: DataFrame) -> DataFrame:
    """(src_table, row_id, ref_id) for rows (src_table, row_id, concept, value); ref_id 0 is unmatched.

    Each distinct value of a concept is searched once and the answers joined back.
    Rows without a value (null or null mark) are left out; a concept without a list
    is unmatched; repeated rows each get theirs; values of any length are searched.  Extra
    columns aren't read.
    """
    ship(values.sparkSession)
    lists = reference_lists(reference)
    rows = values.select("src_table", "row_id", "concept", real_value(F.col("value")).alias("value")).where("value is not null")

    @F.pandas_udf("long")
    def search(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        tries = _tries(lists)
        for concepts, texts in batches:
            yield pd.Series([tries[c].match(t) if c in tries else 0 for c, t in zip(concepts, texts, strict=True)], dtype="int64")

    # Few bytes make long searches: the distinct values are spread over all tasks before the search, small
    # batches of them, so that a few dear ones don't meet in one task.
    distinct = rows.select("concept", "value").distinct()
    spread = distinct.repartition(max(distinct.sparkSession.sparkContext.defaultParallelism * 4, int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "concept", "value")
    answers = spread.withColumn("ref_id", search("concept", "value"))
    return rows.join(answers, ["concept", "value"], "left").select("src_table", "row_id", F.coalesce("ref_id", F.lit(0)).alias("ref_id"))
