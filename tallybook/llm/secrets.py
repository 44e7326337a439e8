"""Secret scans: fixed patterns, and automata that were inferred from credentials the patterns found.

The patterns label credentials by kind. From a bounded sample of them a probabilistic automaton is inferred for each
kind: the credentials form a prefix tree that counts how often each state goes on with each letter or ends, and states
whose frequencies are compatible (Hoeffding's bound, for all states behind them too) are merged. A further automaton
is inferred from ordinary candidates. All candidates of all texts are then scored: how much likelier is the format of a
kind than ordinary text? The likeliest kind gives the span its name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import stored

#: The kinds in the order in which spans that start together are listed, and their patterns.
KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: A candidate is a run of 12 characters or more as credentials have them; equals signs only pad its end.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.-]{11,}[A-Za-z0-9+/_]={0,2}")
#: Every assignment holds one of these, in any case.
HINTS = ["passw", "secret", "token", "api"]
#: Credentials of each kind, and ordinary candidates, from which an automaton is inferred at most; their characters;
#: and the credentials that an automaton needs.
SAMPLE, ORDINARY, LONGEST, FEWEST = 1_000, 4_000, 200, 20
#: States are compatible if their frequencies could be equal at this error.
ALPHA = 0.05
#: A candidate is a secret if its format is likelier than ordinary text by this many nats, and this many for each letter,
#: and no less likely than that of all but a fiftieth of the kind's own credentials.
NATS, EACH = 12.0, 0.7


SPAN = ["kind", "start", "end", "secret"]
OPEN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("secret", pa.string())]))
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("secret", pa.string())]))
FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("added", pa.bool_())]))


@dataclass(frozen=True)
class Automaton:
    """A deterministic probabilistic automaton: log-likelihoods of going on with a letter, and of ending, by state.

    A letter that a state never saw costs what is rare for letters of its class, and leads to the start of the state
    that follows most often, so odd candidates are unlikely and not impossible.
    """

    follow: list[dict[str, int]]
    cost: list[dict[str, float]]
    end: list[float]
    other: list[dict[str, float]]
    usual: list[int]

    def score(self, text: str) -> float:
        """The log-likelihood of the text."""
        state, total = 0, 0.0
        for letter in text:
            known = self.cost[state].get(letter)
            if known is None:
                total += self.other[state].get(class_of(letter), OUTSIDE)
                state = self.usual[state]
            else:
                total += known
                state = self.follow[state][letter]
        return total + self.end[state]


#: The log-likelihood of a letter of a class that a state never saw.
OUTSIDE = math.log(1e-4)
CLASSES = {"digit": "0123456789", "low": "abcdef", "lower": "ghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "sign": "+/_.=-"}
CLASS = {letter: name for name, letters in CLASSES.items() for letter in letters}


def class_of(letter: str) -> str:
    return CLASS.get(letter, "else")


class Prefixes:
    """A prefix tree whose states can be merged: how often each was reached, ended, and went on by each letter."""

    def __init__(self, words: Iterable[str]):
        self.reached, self.ended, self.next, self.moves = [0], [0], [{}], [{}]
        for word in words:
            state = 0
            self.reached[0] += 1
            for letter in word:
                self.moves[state][letter] = self.moves[state].get(letter, 0) + 1
                then = self.next[state].get(letter)
                if then is None:
                    then = self.next[state][letter] = len(self.next)
                    self.reached.append(0)
                    self.ended.append(0)
                    self.next.append({})
                    self.moves.append({})
                state = then
                self.reached[state] += 1
            self.ended[state] += 1

    def by_class(self, state: int) -> dict[str, int]:
        """How often a state went on by a letter of each class."""
        found: dict[str, int] = {}
        for letter, n in self.moves[state].items():
            name = CLASS.get(letter, "else")
            found[name] = found.get(name, 0) + n
        return found

    def apart(self, one: int, other: int) -> float:
        """How different the frequencies of the classes are, and that of ending."""
        a, b, n, m = self.by_class(one), self.by_class(other), self.reached[one], self.reached[other]
        ends = abs(self.ended[one] / n - self.ended[other] / m)
        return ends + sum(abs(a.get(c, 0) / n - b.get(c, 0) / m) for c in sorted(a.keys() | b.keys()))

    def alike(self, first: int, second: int) -> bool:
        """Whether the frequencies of ending, of each class and of each letter could be the same, behind the states too."""
        open_ = [(first, second)]
        while open_:
            a, b = open_.pop()
            n, m = self.reached[a], self.reached[b]
            bound = BOUND * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if bound >= 1:
                continue  # too few to tell, and what lies behind is fewer
            if abs(self.ended[a] / n - self.ended[b] / m) > bound:
                return False
            one, other = self.by_class(a), self.by_class(b)
            if any(abs(one.get(c, 0) / n - other.get(c, 0) / m) > bound for c in one.keys() | other.keys()):
                return False
            for letter in self.moves[a].keys() | self.moves[b].keys():
                if abs(self.moves[a].get(letter, 0) / n - self.moves[b].get(letter, 0) / m) > bound:
                    return False
                x, y = self.next[a].get(letter), self.next[b].get(letter)
                if x is not None and y is not None and x != y:
                    open_.append((x, y))
        return True

    def fold(self, into: int, tree: int) -> list[tuple[int, str]]:
        """Add the counts of the subtree at ``tree`` to the states that its letters lead to from ``into``. Returns the
        states and letters at which a part of it was hung up."""
        hung = []
        open_ = [(into, tree)]
        while open_:
            a, b = open_.pop()
            self.reached[a] += self.reached[b]
            self.ended[a] += self.ended[b]
            for letter, y in self.next[b].items():
                self.moves[a][letter] = self.moves[a].get(letter, 0) + self.moves[b][letter]
                x = self.next[a].get(letter)
                if x is None:
                    self.next[a][letter] = y
                    hung.append((a, letter))
                else:
                    open_.append((x, y))
        return hung


#: Half the width of Hoeffding's interval around a frequency of one observation.
BOUND = math.sqrt(0.5 * math.log(2 / ALPHA))


def infer(words: Sequence[str]) -> Automaton:
    """The automaton of these words: each state behind the kept ones is merged into the closest compatible one, or kept."""
    tree = Prefixes(w[:LONGEST] for w in words)
    kept = {0: None}
    waiting = {(0, letter): None for letter in sorted(tree.next[0])}
    while waiting:
        # the way that most words take is decided first, as its frequencies are known best
        state, letter = max(waiting, key=lambda way: (tree.moves[way[0]][way[1]], way))
        del waiting[state, letter]
        then = tree.next[state][letter]
        if then in kept:
            continue
        same = min((k for k in kept if tree.alike(k, then)), key=lambda k: (tree.apart(k, then), k), default=None)
        if same is None:
            kept[then] = None
            waiting |= {(then, one): None for one in sorted(tree.next[then])}
        else:
            tree.next[state][letter] = same
            waiting |= {way: None for way in sorted(tree.fold(same, then)) if way[0] in kept}
    number = {k: i for i, k in enumerate(kept)}
    follow, cost, end, other, usual = [], [], [], [], []
    for k in kept:
        held, n = tree.next[k], tree.moves[k]
        total = sum(n.values()) + tree.ended[k] + 1.0
        by_class = tree.by_class(k)
        # a fiftieth of what a class has goes to all its letters alike, seen or not
        share = {c: 0.02 * m / total / len(CLASSES.get(c, "x" * 1000)) for c, m in by_class.items()}
        follow.append({letter: number[then] for letter, then in held.items()})
        cost.append({letter: math.log(0.98 * count / total + share[class_of(letter)]) for letter, count in n.items()})
        end.append(math.log((tree.ended[k] + 0.01) / total))
        other.append({c: math.log(p) for c, p in share.items()})
        usual.append(number[held[max(n, key=lambda x: (n[x], x))]] if n else 0)
    return Automaton(follow, cost, end, other, usual)


@dataclass(frozen=True)
class Model:
    """Automata by kind, the least likelihood of a letter by which a kind's own credentials are told, and the automaton
    of ordinary candidates."""

    kinds: dict[str, Automaton]
    least: dict[str, float]
    ordinary: Automaton | None

    def judge(self, text: str) -> str | None:
        """The kind whose format makes a candidate a secret; of equally likely ones the first."""
        if self.ordinary is None or not self.kinds:
            return None
        score, _, kind = max((self.kinds[k].score(text), -i, k) for i, k in enumerate(KINDS) if k in self.kinds)
        if score < self.least[kind] * (len(text) + 1):
            return None
        return kind if score - self.ordinary.score(text) > max(NATS, EACH * len(text)) else None


def fit(labelled: dict[str, Sequence[str]], ordinary: Sequence[str], fewest: int = FEWEST) -> Model:
    """Infer an automaton for each kind with at least ``fewest`` credentials; none without ordinary candidates."""
    kinds = {k: infer(words) for k, words in sorted(labelled.items()) if len(words) >= fewest}
    least = {}
    for k, automaton in kinds.items():
        each = sorted(automaton.score(w[:LONGEST]) / (len(w[:LONGEST]) + 1) for w in labelled[k])
        least[k] = each[len(each) // 50]
    return Model(kinds, least, infer(ordinary) if ordinary else None)


def matches(text: str) -> list[tuple[str, int, int, str]]:
    """What the patterns find: kind, start, end (code points), credential; by start, then by kind."""
    found = []
    low = text.lower()
    if any(hint in low for hint in HINTS):
        found += [("assign", m.start(), m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def candidates(text: str, found: list[tuple[str, int, int, str]]) -> list[tuple[int, int, str]]:
    """The candidates that touch no span the patterns found: start, end, text."""
    out, at, reached = [], 0, 0
    for m in CANDIDATE.finditer(text):
        while at < len(found) and found[at][1] < m.end():
            reached = max(reached, found[at][2])
            at += 1
        if reached <= m.start():
            out.append((m.start(), m.end(), m[0]))
    return out


def gathered(docs: DataFrame) -> DataFrame:
    """row, doc_id, base (what the patterns find) and candidates of every document, from one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 500):
                part = batch.slice(begin, 500)
                base, open_ = [], []
                for text in part.column("text").to_pylist():
                    found = matches(text or "")
                    base.append([dict(zip(SPAN, f, strict=True)) for f in found])
                    open_.append([dict(zip(SPAN[1:], c, strict=True)) for c in candidates(text or "", found)])
                columns = [part.column("row"), part.column("doc_id"), pa.array(base, SPANS), pa.array(open_, OPEN)]
                yield pa.record_batch(columns, ["row", "doc_id", "base", "candidates"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, base array<struct<kind:string,start:int,end:int,secret:string>>"
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, schema + ", candidates array<struct<start:int,end:int,secret:string>>")


def sampled(found: DataFrame, size: int) -> list[str]:
    """``size`` of the strings in ``secret``, chosen by a hash of where they stand; each task hands on as many at most."""
    least = F.xxhash64("row", "start")
    return [r.secret for r in found.select("secret", least.alias("h"), "row", "start").orderBy("h", "row", "start").limit(size).collect()]


def scan(docs: DataFrame, *, sample: int = SAMPLE, ordinary: int = ORDINARY, fewest: int = FEWEST) -> DataFrame:
    """doc_id, spans (kind, start, end, added) of every document, by start, then by kind as in KINDS.

    ``added`` is false for what the patterns find and true for candidates whose format an automaton recognizes. The
    automata are inferred from at most ``sample`` credentials of each kind and ``ordinary`` candidates, cut at 200
    characters, in the driver; a kind with under ``fewest`` credentials gets none. Every candidate of every whole text
    is scored. Null and empty texts have no spans. Repeated rows and null doc_ids are documents of their own. Ties
    between kinds go to the first. An empty table gives no rows. Columns other than doc_id and text are ignored. The
    texts are read once; spans and candidates are stored in between.
    """
    found = stored(gathered(docs), "secret-candidates")
    base = found.select("row", F.explode("base").alias("b")).select("row", "b.start", "b.kind", F.substring("b.secret", 1, LONGEST).alias("secret"))
    labelled = {k: sampled(base.where(F.col("kind") == k), sample) for k in KINDS}
    open_ = found.select("row", F.explode("candidates").alias("c")).select("row", "c.start", F.substring("c.secret", 1, LONGEST).alias("secret"))
    model = fit(labelled, sampled(open_, ordinary), fewest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str | None] = {}
        for batch in batches:
            out = []
            for base, more in zip(batch.column("base").to_pylist(), batch.column("candidates").to_pylist(), strict=True):
                spans = [(b["start"], KINDS.index(b["kind"]), b["end"], False) for b in base]
                for c in more:
                    text = c["secret"]
                    if text not in known:
                        if len(known) > 100_000:
                            known.clear()
                        known[text] = model.judge(text)
                    if known[text]:
                        spans.append((c["start"], KINDS.index(known[text]), c["end"], True))
                out.append([{"kind": KINDS[k], "start": a, "end": e, "added": new} for a, k, e, new in sorted(spans)])
            yield pa.record_batch([batch.column("doc_id"), pa.array(out, FOUND)], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, spans array<struct<kind:string,start:int,end:int,added:boolean>>"
    return found.select("doc_id", "base", "candidates").mapInArrow(run, schema)


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
