"""Operator 1: toxicity by a weighted finite-state pattern grammar.

Five small weighted transducers read a clause's words as classes (a lexicon of stems gives each word its class):
  threat    rewrites the last word of a threat phrase to 'threat' where an intent ('will', 'going') stands close before it;
  insult    chooses one insult or threat of the clause as its match, in every way there is, and weighs it;
  negation  adds a weight if the match stands in reach of a negation;
  reported  adds a weight if the match comes after a verb of speech;
  target    adds a weight if the match has a person in reach, before or after it.
Their composition (see compose) reads a clause once. Each path through it is one reading of the clause: a match and the arcs
that weigh it. It is made deterministic as clauses ask for it (Machine): a table from (set of paths, class) to the next set. A
clause is scored once, by its best path; clauses without a match do not count. A document's score is logistic in the log
counts of the arcs that its clauses' best paths take, which are the weights of the arcs.

Learning: stems come from counts over at most POSITIVES + NEGATIVES labelled documents, chosen by a hash of their id (the
labels of equal texts are joined, toxic if any is); the arcs' weights are fitted on the same rows, and the best paths chosen
anew with them until they stay. Labels, language, source and id are never inputs of a score.

Cases: null or empty text has no clause and gets the score of a text without matches; labels that are null, or of ids without
a document, teach nothing; with no label of one kind the given lexicon and default weights hold; repeated rows each get their
score; very long texts and clauses are read whole; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillseq.llm.common import LOWER, crc_mod, discard, encoded, pieces, release, settle, table, utf8
from quillseq.llm.tokenize import chunks

#: The bounded sample to learn from.
POSITIVES, NEGATIVES = 4_000, 16_000

#: The given part of the lexicon, lower case.
INSULTS = ("idiot", "moron", "loser", "scum", "trash", "stupid", "pathetic", "worthless", "disgusting", "clown")
THREATS = (("kill",), ("hurt",), ("destroy",), ("hunt", "down"), ("beat", "up"), ("make", "pay"))
INTENT = ("will", "gonna", "shall", "going", "must")
TARGETS = ("you", "your", "yours", "youre", "yourself", "u", "he", "she", "they", "him", "her", "them", "those", "these")
NEGATIONS = ("not", "no", "never", "isnt", "arent", "wasnt", "dont", "doesnt", "didnt", "wont", "without", "hardly")
REPORTS = ("said", "says", "called", "wrote", "writes", "claimed", "claims", "quoted", "according", "reported", "alleged")

#: Words within which an intent, a negation and a target reach a match, and those within which a threat phrase must end.
NEAR_INTENT, NEAR_NEGATION, NEAR_TARGET, NEAR_REST = 3, 5, 6, 3

#: The weighted arcs, and weights where nothing can be learned: of a text without a match, then of each arc.
ARCS = ("insult", "insult_at_target", "insult_negated", "insult_reported", "threat", "threat_at_target", "threat_negated", "threat_reported")
PLAIN = (-3.0, 4.5, 1.0, -3.0, -2.5, 4.5, 1.0, -3.0, -2.5)

#: Word classes: the alphabet that the threat transducer reads. A phrase of two words has a class for each of them.
OTHER, END = 0, 255
PHRASES = [t for t in THREATS if len(t) > 1]
CLASSES = ["other", "insult", "target", "negation", "report", "intent", "verb", *(w for t in PHRASES for w in t)]
STEP = 2 << 20

_TOKEN = re.compile("[^\\W\\d_]+(?:'[^\\W\\d_]+)?|[.!?;:\\n\\x00]")


class Fst:
    """A weighted transducer that writes a symbol for each it reads. rule(state, symbol) gives its arcs as (next state,
    symbol written, names of weights); final(state) says whether a path may end there."""

    def __init__(self, start, rule, final=lambda state: True):
        self.start, self.rule, self.final = start, rule, final


def compose(a: Fst, b: Fst) -> Fst:
    """What a writes, b reads; weights add up."""
    def rule(state, symbol):
        return [((p, q), out, v + w) for p, mid, v in a.rule(state[0], symbol) for q, out, w in b.rule(state[1], mid)]

    return Fst((a.start, b.start), rule, lambda state: a.final(state[0]) and b.final(state[1]))


def _reach(age: int | None, most: int) -> int | None:
    """The age of something seen, a word later; None: out of reach, or never seen."""
    return None if age is None or age >= most else age + 1


def threat() -> Fst:
    def rule(state, symbol):
        intent, first, since = state
        intent, since = _reach(intent, NEAR_INTENT), _reach(since, NEAR_REST)
        first = first if since is not None else None
        out = symbol if symbol in ("insult", "target", "negation", "report") else "other"
        if symbol == "intent":
            return [((0, None, None), "other", ())]
        if symbol == "verb" and intent is not None or first is not None and (first, symbol) in PHRASES:
            return [((intent, None, None), "threat", ())]
        if intent is not None and any(symbol == t[0] for t in PHRASES):
            first, since = symbol, 0
        return [((intent, first, since), out, ())]

    return Fst((None, None, None), rule)


def insult() -> Fst:
    """Chooses the clause's match: state 0 before it, 1 after it."""
    def rule(state, symbol):
        if symbol not in ("insult", "threat"):
            return [(state, symbol, ())]
        skip = [(state, "other", ())]
        return skip if state else [*skip, (1, f"{symbol}!", (symbol,))]

    return Fst(0, rule, lambda state: state == 1)


def negation() -> Fst:
    def rule(age, symbol):
        age = _reach(age, NEAR_NEGATION)
        if symbol == "negation":
            return [(0, "other", ())]
        return [(age, symbol, (f"{symbol[:-1]}_negated",) if symbol.endswith("!") and age is not None else ())]

    return Fst(None, rule)


def reported() -> Fst:
    def rule(inside, symbol):
        return [(inside or symbol == "report", "other" if symbol == "report" else symbol, (f"{symbol[:-1]}_reported",) if symbol.endswith("!") and inside else ())]

    return Fst(False, rule)


def target() -> Fst:
    """State: the age of the last target; or the match that waits for one and its age; or 'done'."""
    def rule(state, symbol):
        if state == "done":
            return [("done", symbol, ())]
        if isinstance(state, tuple):
            kind, age = state
            age = _reach(age, NEAR_TARGET)
            if age is None:
                return []  # none came: another path has the match without a target
            return [("done", symbol, (f"{kind}_at_target",))] if symbol == "target" else [((kind, age), symbol, ())]
        age = _reach(state, NEAR_TARGET)
        if symbol == "target":
            return [(0, symbol, ())]
        if not symbol.endswith("!"):
            return [(age, symbol, ())]
        kind = symbol[:-1]
        if age is not None:
            return [("done", symbol, (f"{kind}_at_target",))]
        return [("done", symbol, ()), ((kind, 0), symbol, ())]

    return Fst(None, rule, lambda state: not isinstance(state, tuple))


def grammar() -> Fst:
    return compose(compose(compose(compose(threat(), insult()), negation()), reported()), target())


def readings() -> list[tuple[str, ...]]:
    """The arcs of each kind of path: an event and which of the three weights it takes."""
    return [tuple(n for n, on in zip(ARCS[4 * k : 4 * k + 4], (1, *more), strict=True) if on) for k in (0, 1) for more in product((0, 1), repeat=3)]


READINGS = readings()
_READING = {frozenset(r): i for i, r in enumerate(READINGS)}
#: Arcs (columns) of each reading (rows).
_USES = np.array([[a in r for a in ARCS] for r in READINGS], float)


class Machine:
    """The composition, made deterministic: a state is a set of (state of the composition, weights so far), and the table of
    its transitions fills as clauses ask for it. What a clause ends in is the set of its readings, as bits."""

    MOST = 1 << 16  # states kept; beyond it the table is begun anew

    def __init__(self, fst: Fst):
        self.fst = fst
        self.clear()

    def clear(self) -> None:
        self.sets, self.number, self.next, self.ends = [], {}, [], []
        self._state(frozenset({(self.fst.start, ())}))

    def _state(self, s: frozenset) -> int:
        if s not in self.number:
            self.number[s] = len(self.sets)
            self.sets.append(s)
            self.next.append([-1] * len(CLASSES))
            self.ends.append(sum({1 << _READING[frozenset(w)] for q, w in s if w and self.fst.final(q)}))
        return self.number[s]

    def read(self, classes) -> int:
        """The readings of a clause, as bits."""
        if len(self.sets) > self.MOST:
            self.clear()
        at, table = 0, self.next
        for c in classes:
            to = table[at][c]
            if to < 0:
                arcs = ((q, v) for p, w in self.sets[at] for q, _, more in self.fst.rule(p, CLASSES[c]) for v in [tuple(sorted((*w, *more)))])
                to = table[at][c] = self._state(frozenset(arcs))
            at = to
        return self.ends[at]


class Lexicon(dict):
    """Word -> class, filled as words come. stems: word prefixes; those that end in '$' must match whole words."""

    def __init__(self, stems: list[str]):
        super().__init__({m: END for m in ".!?;:\n"})
        self.prefix = {s for s in stems if not s.endswith("$")}
        self.sizes = sorted({len(s) for s in self.prefix})
        self.fixed = {s[:-1]: "insult" for s in stems if s.endswith("$")} | {w: w for t in PHRASES for w in t} | {t[0]: "verb" for t in THREATS if len(t) == 1}
        for words, kind in ((TARGETS, "target"), (NEGATIONS, "negation"), (REPORTS, "report"), (INTENT, "intent")):
            self.fixed |= dict.fromkeys(words, kind)

    def __missing__(self, word: str) -> int:
        w = word.replace("'", "")
        kind = self.fixed.get(w) or ("insult" if any(w[:n] in self.prefix for n in self.sizes if n <= len(w)) else "other")
        if len(self) > 1 << 18:  # a cache: words of the corpus come and go
            self.clear()
            self.update({m: END for m in ".!?;:\n"})
        out = self[word] = CLASSES.index(kind)
        return out


def classes(lexicon: Lexicon, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The class of every word and END for every clause mark, in text order, and where each document's begin (and the end).
    Each distinct piece of text is looked up once."""
    buf, offs = utf8(column)
    buf = LOWER[np.where(buf == 0, np.uint8(32), buf)]
    cuts = pieces(buf, offs)
    if len(cuts) < 2:
        return np.zeros(0, np.uint8), np.zeros(len(offs), np.int64)
    uniq, idx = encoded(buf, cuts)
    whole = b"\0".join([*uniq.to_pylist(), b""]).decode("utf-8", "replace").lower().replace("\u2019", "'")
    lexicon["\0"] = END
    tokens = _TOKEN.findall(whole)
    code = np.fromiter(map(lexicon.__getitem__, tokens), np.uint8, len(tokens))
    ends = np.flatnonzero(np.fromiter((t == "\0" for t in tokens), bool, len(tokens)))  # a piece ends with its mark
    begin = np.concatenate([[0], ends[:-1] + 1])
    n = (ends - begin)[idx]
    stop = np.cumsum(n)
    at = np.arange(stop[-1]) + np.repeat(begin[idx] - (stop - n), n)
    return code[at], np.concatenate([[0], stop])[np.searchsorted(cuts[:-1], offs)]


class Reader:
    """Reads documents: per matched clause, its document and its readings as bits."""

    def __init__(self, stems: list[str]):
        self.lexicon, self.machine = Lexicon(stems), Machine(grammar())
        self.events = np.zeros(256, bool)
        self.events[[CLASSES.index("insult"), CLASSES.index("verb"), *(CLASSES.index(t[1]) for t in PHRASES)]] = True

    def read(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        code, first = classes(self.lexicon, column)
        at = np.flatnonzero(self.events[code])  # a clause without one of these has no match
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        mark = code == END
        edge = np.unique(np.concatenate([np.flatnonzero(mark) + 1, first]))  # where clauses begin, and the end
        k = np.unique(np.searchsorted(edge, at, "right"))
        begin, end = edge[k - 1], edge[k]
        end = end - mark[end - 1]
        raw, read = code.tobytes(), self.machine.read
        got = np.fromiter((read(raw[a:b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)), np.int64, len(k))
        doc = np.searchsorted(first, begin, "right") - 1
        return doc[got > 0], got[got > 0]


def best(weights: np.ndarray) -> np.ndarray:
    """Of each set of readings (as bits): the reading of greatest weight, the first of equals; -1 for none."""
    worth = _USES @ np.asarray(weights)[1:]
    out = np.full(1 << len(READINGS), -1, np.int8)
    sets = np.arange(1 << len(READINGS))
    for i in np.argsort(-worth, kind="stable")[::-1]:  # the best comes last and stays
        out[sets >> i & 1 == 1] = i
    return out


def features(doc: np.ndarray, found: np.ndarray, n_docs: int, chosen: np.ndarray) -> np.ndarray:
    """Per document, the log counts of the arcs that its clauses' best paths take."""
    count = np.zeros((n_docs, len(ARCS)))
    np.add.at(count, doc, _USES[chosen[found]])
    return np.log1p(count)


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, doc_id and toxic of at most POSITIVES + NEGATIVES labelled training rows, by a hash of their id; equal texts are
    one row, of the least id, toxic if any of them is."""
    rows = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(crc_mod(F.col("doc_id"), 5) != 0)
    rows = rows.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    pick = lambda kind, n: rows.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    ids = pick(1, POSITIVES).unionByName(pick(0, NEGATIVES))  # bounded by the two parameters, so fit to broadcast
    held = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(ids), "doc_id")
    return settle(held.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")), "toxic-sample")


def learn_stems(rows: DataFrame, least: int = 8, ratio: float = 100.0) -> list[str]:
    """Whole words and word prefixes of 4 to 6 letters, by how much more often toxic documents hold them."""
    kinds = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not kinds.get(0) or not kinds.get(1):
        return [f"{w}$" for w in INSULTS]
    w = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))))
    marks = F.explode(F.array_distinct(F.flatten(F.array(F.array(F.concat("_w", F.lit("$"))), F.transform(F.filter(F.array(*map(F.lit, (4, 5, 6))), lambda k: k < F.length("_w")), lambda k: F.substring(F.col("_w"), F.lit(1), k))))))
    seen = lambda kind: rows.where(F.col("toxic") == kind).select("doc_id", w.alias("_w")).select("doc_id", marks.alias("mark")).distinct().groupBy("mark").agg(F.count(F.lit(1)).alias("n"))
    pos = seen(1).where(F.col("n") >= least).withColumnRenamed("n", "p")
    both = pos.join(seen(0), "mark", "left").select("mark", "p", F.coalesce("n", F.lit(0)).alias("n"))
    odds = (F.col("p") + 0.1) / kinds[1] / ((F.col("n") + 0.1) / kinds[0])
    good = both.where(odds >= ratio)
    held: dict[str, set[int]] = {}  # marks that at least `least` of at most POSITIVES documents hold
    for r in rows.where(F.col("toxic") == 1).select("doc_id", w.alias("_w")).select("doc_id", marks.alias("mark")).distinct().join(good, "mark").groupBy("mark").agg(F.collect_list("doc_id").alias("ids")).collect():
        held[r["mark"]] = set(r["ids"])
    # greedy cover: a document that marks taken before explain k times counts 1 / (1 + k), so the words of a copied or
    # topical text stop paying; of equal marks the longest is taken
    kept: list[str] = []
    times: dict[int, int] = {}
    while held:
        worth = {m: round(sum(1 / (1 + times.get(d, 0)) for d in ids), 6) for m, ids in held.items()}
        mark = max(worth, key=lambda m: (worth[m], len(m), m))
        if worth[mark] < least:
            break
        kept.append(mark)
        for d in held.pop(mark):
            times[d] = times.get(d, 0) + 1
        held = {m: ids for m, ids in held.items() if worth[m] >= least and not m.startswith(mark) and not mark.startswith(m)}
    return sorted({*kept, *(f"{w}$" for w in INSULTS)})


def fit(rows: DataFrame, stems: list[str], rounds: int = 8, steps: int = 60) -> list[float]:
    """The weights: of a text without a match, and of each arc. With the best paths given they come from damped Newton steps,
    held to PLAIN by a unit prior; best paths and weights are found in turn until the paths stay."""
    def read(batches):
        reader = Reader(stems)
        for b in batches:
            for i, j in chunks(b.column("text"), STEP):
                doc, found = reader.read(b.column("text").slice(i, j - i))
                per: list[list[int]] = [[] for _ in range(j - i)]
                for d, f in zip(doc.tolist(), found.tolist(), strict=True):
                    per[d].append(f)
                yield pa.RecordBatch.from_arrays([pa.array([sorted(p) for p in per], pa.list_(pa.int64())), b.column("toxic").slice(i, j - i).cast(pa.int32())], names=["e", "y"])

    per = rows.select("text", "toxic").mapInArrow(read, "e array<long>, y int").groupBy("e", "y").agg(F.count(F.lit(1)).alias("n")).orderBy("y", "e").collect()  # bounded by the sample
    if {r["y"] for r in per} != {0, 1}:
        return list(PLAIN)
    doc = np.repeat(np.arange(len(per)), [len(r["e"]) for r in per])
    found = np.array([f for r in per for f in r["e"]], np.int64)
    y, n = np.array([r["y"] for r in per], float), np.array([r["n"] for r in per], float)
    prior = w = np.array(PLAIN)
    chosen = best(w)
    for _ in range(rounds):
        x = np.concatenate([np.ones((len(per), 1)), features(doc, found, len(per), chosen)], 1)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-x @ w))
            grad = x.T @ (n * (p - y)) + (w - prior)
            hess = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
            step = np.linalg.solve(hess, grad)
            w = w - step * min(1.0, 4.0 / max(1e-9, float(np.abs(step).max())))
        again = best(w)
        if np.array_equal(again, chosen):
            break
        chosen = again
    return [float(v) for v in w]


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[float]]:
    rows = sample(docs, labels)
    stems = learn_stems(rows)
    model = stems, fit(rows, stems)
    discard(rows)
    return model


def score(docs: DataFrame, model: tuple[list[str], list[float]], column: str = "score") -> DataFrame:
    """docs with the column (0 to 1). Rows stream through; a task holds one batch."""
    stems, weights = model
    schema = docs.drop(column).withColumn(column, F.lit(0.0)).schema

    def run(batches):
        reader, w, b = Reader(stems), np.array(weights), None
        chosen = best(w)
        for b in batches:
            for i, j in chunks(b.column("text"), STEP):
                x = features(*reader.read(b.column("text").slice(i, j - i)), j - i, chosen)
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, pa.array(1 / (1 + np.exp(-(w[0] + x @ w[1:]))))], names=[*b.schema.names, column])
        del b
        release()

    return docs.drop(column).mapInArrow(run, schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
