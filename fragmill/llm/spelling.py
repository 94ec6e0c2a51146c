"""Spelling variants: pairs of words one edit apart, by composing finite-state machines."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard, partitions

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: One run in so many loses a code point, chosen by a checksum of its document and itself.
EVERY = 31
LEAST_LENGTH = 7
LEAST_N = 2
#: A form is so many times as frequent as the word.
RATIO = 10
#: Words that a task counts before it hands their counts on.
COUNTED = 400_000
#: Words of one partition of the machine; larger ones are split at a later symbol.
GROUP = 20_000


def counted_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int | None = None) -> DataFrame:
    """(word, n): how often every run of letters stands in all texts, with A-Z lower-cased.

    With every, a run whose crc32 of '<id>:<run>' is divisible by it loses the code
    point at crc32 modulo its length. Null texts have no runs, and a null id is
    the text 'null'. Tasks count before anything is shuffled.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(total.keys(), pa.string()), "n": pa.array(total.values(), pa.int64())})
            total.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = Counter(LETTERS.findall((text.as_py() or "").translate(_LOWER)))
                if every:
                    start = zlib.crc32(f"{'null' if doc is None else doc}:".encode())
                    for run, n in list(own.items()):
                        h = zlib.crc32(run.encode(), start)
                        if h % every == 0:
                            at = h % len(run)
                            del own[run]
                            total[run[:at] + run[at + 1 :]] += n
                for run, n in own.items():
                    total[run] += n
                if len(total) >= COUNTED:
                    yield flush()
        yield flush()

    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Acceptor:
    """The minimal acyclic machine of a sorted list of different words; states with equal futures are one.

    arcs[q] maps a symbol to the next state, and final holds the accepting states.
    """

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final: set[int] = set()
        self._known: dict[tuple, int] = {}
        self._path: list[tuple[int, str, int]] = []
        before = ""
        for word in words:
            same = 0
            while same < min(len(word), len(before)) and word[same] == before[same]:
                same += 1
            self._close(same)
            at = self._path[-1][2] if self._path else 0
            for symbol in word[same:]:
                self.arcs.append({})
                self.arcs[at][symbol] = len(self.arcs) - 1
                self._path.append((at, symbol, len(self.arcs) - 1))
                at = len(self.arcs) - 1
            self.final.add(at)
            before = word
        self._close(0)

    def _close(self, depth: int) -> None:
        """Replaces the states below a depth of the last word by known ones with the same future."""
        while len(self._path) > depth:
            q, symbol, r = self._path.pop()
            future = (r in self.final, tuple(self.arcs[r].items()))
            self.arcs[q][symbol] = self._known.setdefault(future, r)


class OneEdit:
    """The composition of an acceptor, a transducer of exactly one edit, and the acceptor again.

    Before the edit both tapes read the same, so both machines are in one state;
    after it they are in two, and a pair of words is accepted where both end. Only
    a replacement by a larger symbol or a deletion is taken, so each pair comes
    once; of a run of one symbol the last is deleted. A deleted last symbol of the
    first tape counts only with at_end: otherwise what follows the words is known
    to be read by another part of the vocabulary's machine.
    """

    def __init__(self, acceptor: Acceptor, at_end: bool):
        self.a, self.at_end = acceptor, at_end
        self._meets: dict[tuple[int, int, str | None], bool] = {}
        self._edits: dict[int, list[tuple[str, str, int, int, str | None]]] = {}
        self._leads: dict[int, bool] = {}

    def _ends(self, q: int, r: int, barred: str | None) -> bool:
        return q in self.a.final and r in self.a.final and (barred is None or self.at_end)

    def _ahead(self, q: int, r: int, barred: str | None) -> Iterator[tuple[str, tuple[int, int, None]]]:
        """The symbols that both machines can read next, and where they lead."""
        for c, x in self.a.arcs[q].items():
            y = self.a.arcs[r].get(c)
            if y is not None and c != barred:
                yield c, (x, y, None)

    def meets(self, q: int, r: int, barred: str | None) -> bool:
        """Whether some text ends both machines from q and r, its first symbol not the barred one."""
        stack = [(q, r, barred)]
        while stack:
            state = stack[-1]
            known = self._meets.get(state)
            if known is None:
                nexts = [self._meets.get(n, n) for _, n in self._ahead(*state)]
                if self._ends(*state) or True in nexts:
                    known = True
                elif unknown := [n for n in nexts if n is not False]:
                    stack.append(unknown[0])
                    continue
                else:
                    known = False
                self._meets[state] = known
            stack.pop()
        return self._meets[(q, r, barred)]

    def edits(self, q: int) -> list[tuple[str, str, int, int, str | None]]:
        """(read, written, state, state, barred symbol) of every edit at q that some pair of words makes."""
        if q not in self._edits:
            arcs = sorted(self.a.arcs[q].items())
            found = [(c, d, x, y, None) for i, (c, x) in enumerate(arcs) for d, y in arcs[i + 1 :]]
            found += [(c, "", x, q, c) for c, x in arcs]
            self._edits[q] = [e for e in found if self.meets(*e[2:])]
        return self._edits[q]

    def leads(self, q: int) -> bool:
        """Whether some pair has its edit at q or at a state beyond."""
        stack = [q]
        while stack:
            at = stack[-1]
            if at not in self._leads:
                if unknown := [x for x in self.a.arcs[at].values() if x not in self._leads]:
                    stack += unknown
                    continue
                self._leads[at] = bool(self.edits(at)) or any(self._leads[x] for x in self.a.arcs[at].values())
            stack.pop()
        return self._leads[q]

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Every accepted pair of words."""
        stack = [(0, "")]
        while stack:
            q, read = stack.pop()
            for c, d, x, y, barred in self.edits(q):
                for rest in self._common(x, y, barred):
                    yield read + c + rest, read + d + rest
            stack += [(x, read + c) for c, x in self.a.arcs[q].items() if self.leads(x)]

    def _common(self, q: int, r: int, barred: str | None) -> Iterator[str]:
        """The texts that end both machines."""
        stack = [((q, r, barred), "")]
        while stack:
            state, read = stack.pop()
            if self._ends(*state):
                yield read
            stack += [(n, read + c) for c, n in self._ahead(*state) if self.meets(*n)]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, n_a, n_b) of the words of each key of a partition sorted by key; batches may split a key."""
    key, words = None, {}

    def found() -> Iterator[pa.RecordBatch]:
        if len(words) < 2:
            return
        s, i, j = map(int, key.split(":", 3)[:3])
        right = max(0, s - j)
        middles = sorted((w[i : len(w) - right], w) for w in words)
        whole = dict(middles)
        out = [(whole[x], whole[y]) for x, y in OneEdit(Acceptor([m for m, _ in middles]), j > s).pairs()]
        # Two words of the longer length meet under the key of that length.
        out = [(x, y) for x, y in out if min(len(x), len(y)) == s]
        for k in range(0, len(out), 50_000):
            part = out[k : k + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in part]), pa.array([y for _, y in part]), pa.array([words[x] for x, _ in part], pa.int64()), pa.array([words[y] for _, y in part], pa.int64())],
                names=["a", "b", "n_a", "n_b"],
            )

    for batch in batches:
        for k, word, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if k != key:
                yield from found()
                key, words = k, {}
            words[word] = n
    yield from found()


def _windowed(rows: DataFrame) -> DataFrame:
    """rows (word, n, s, i, j) with key: what lies left and right of the places i to j - 1 of an edit.

    s is the length of a pair's shorter word. A pair has its edit (of a run, the
    last place) in exactly one of the windows that the places are cut into, and
    agrees outside it.
    """
    right = F.greatest(F.lit(0), F.col("s") - F.col("j"))
    left = F.substring("word", F.lit(1), F.col("i"))
    tail = F.substring("word", F.length("word") - right + 1, right)
    return rows.withColumn("key", F.concat_ws(":", "s", "i", "j", left, tail))


def _split(rows: DataFrame) -> DataFrame:
    """Each row's window as its two halves."""
    middle = ((F.col("i") + F.col("j")) / 2).cast("int")
    halves = F.array(F.struct(F.col("i").alias("i"), middle.alias("j")), F.struct(middle.alias("i"), F.col("j").alias("j")))
    return _windowed(rows.select("word", "n", "s", F.explode(halves).alias("h")).select("word", "n", "s", "h.i", "h.j"))


def near_pairs(words: DataFrame, least: int = LEAST_LENGTH, group: int = GROUP) -> DataFrame:
    """(a, b, n_a, n_b): every pair of different words that one edit turns into each other, once.

    words: (word, n), each word once. Words are partitioned by the state that the
    vocabulary's machine, or that of its reversal, is in after the symbols outside
    a window; in each partition the minimal acceptor of what is left is composed
    with the edit and itself. Words are at least three symbols long. A partition of
    more than group words is cut into windows of half the width until each is small
    enough or one place wide, when the alphabet bounds it.
    """
    shorter = F.array_compact(F.array(F.length("word"), F.when(F.length("word") > least, F.length("word") - 1)))
    rows = words.select("word", "n", F.explode(shorter).alias("s"))
    whole = rows.select("word", "n", "s", F.lit(0).alias("i"), (F.col("s") + 1).alias("j"))
    rows, ready = cut(_split(whole)), []
    while True:
        sizes = cut(rows.groupBy("key").agg(F.count("*").alias("m"), F.max(F.col("j") - F.col("i")).alias("width")))
        large = sizes.where((F.col("m") > group) & (F.col("width") > 1)).select("key")
        if large.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(large, "key", "left_anti"))
        rows = cut(_split(rows.join(large, "key", "left_semi")))
    every = ready[0]
    for more in ready[1:]:
        every = every.unionByName(more)
    every = every.select("key", "word", "n").repartition(partitions(words.sparkSession), "key").sortWithinPartitions("key", "word")
    return every.mapInArrow(_pairs, "a string, b string, n_a long, n_b long")


def spelling_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, form, form_n, n_near, root) of words (word, n).

    form is the near word of largest n (ties: the first in code-point order) where
    that n is ratio times the word's at least; root is the last word that forms
    lead to. As n grows along a way, there is no circle and few steps.
    """
    pairs = cut(near_pairs(words))
    both = pairs.select("a", "b", F.col("n_a").alias("n"), F.col("n_b").alias("m")).union(pairs.select("b", "a", "n_b", "n_a"))
    best = both.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.first("n").alias("n"), F.min(F.struct((-F.col("m")).alias("m"), F.col("b").alias("form"))).alias("best")
    )
    form_n = -F.col("best.m")
    forms = cut(best.select("word", "n_near", F.when(form_n >= ratio * F.col("n"), F.col("best.form")).alias("form"), form_n.alias("form_n")))
    ways = cut(forms.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = cut(ways.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if after.where("moved").isEmpty():
            break
        discard(ways)
        ways = after.drop("moved")
    rows = words.join(forms, "word", "left").join(ways.select("word", "root"), "word", "left")
    return rows.select(
        "word",
        "n",
        "form",
        F.when(F.col("form").isNotNull(), F.col("form_n")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.coalesce("root", "word").alias("root"),
    )


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int | None = EVERY) -> DataFrame:
    """(word, n, form, form_n, n_near, root) of the words of all texts.

    Words have LEAST_LENGTH code points and LEAST_N occurrences at least; see
    counted_words for how runs are read and spelling_groups for the columns. Null
    and empty texts have no words, repeated rows count again, other columns are not
    read, and no rows give no rows.
    """
    words = counted_words(docs, id_col, text_col, every).where((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_N))
    return spelling_groups(cut(words))
