"""Toxicity as a weighted finite-state pattern grammar.

A clause is a string of word classes: insult, threat, target, negation, report, other. Five transducers read it one after
the other, each marking or dropping what it matches: the lexical one knows the classes, the threat one keeps a threat only
where a target is near, and the target, negation and report ones put their mark on every insult or threat in their reach.
compose() makes one machine of them; its best path through a clause says which insults and threats are matched and with
which marks. A clause's score for a label (insult or threat, with its marks) is the weight of the words matched under it.
The insults and their weights are learned from labelled rows, and so are the weights of the labels, which start from the
factors that the grammar states for them; nothing but clause scores enters a text's probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, folded, mix64, span_hashes, text_slices, word_spans

#: Most labelled rows that are learned from (those of least id hash), and most entries of the insult lexicon.
TRAIN_ROWS, LEXICON = 10_000, 4_096
#: Lengths in bytes of word beginnings that can be insult stems.
STEMS = (5, 6, 7, 8)
#: Fixed word lists of the closed classes.
THREATS = "kill hurt destroy burn shoot stab beat punch töten verletzen schlagen tuer frapper blesser matar golpear herir".split()
TARGETS = "you your yours he him she her they them du dich dein ihr euch sie tu toi vous ton ta il elle ils tú usted ustedes él ella ellos".split()
NEGATIONS = "not no never neither without cannot nicht kein keine nie ne pas jamais sans nunca sin ni".split()
REPORTS = "said says say told claims claimed wrote quoted called according sagte sagt behauptet dit disait affirme dijo dice afirma".split()
_OTHER, _INSULT, _THREAT, _TARGET, _NEGATION, _REPORT = range(6)
#: Words that negation and targets reach, and the weight of a threat.
NEGATION_REACH, TARGET_REACH, THREAT_WEIGHT = 3, 4, 5.0
#: Marks of a match, and the factors that they have before any row is seen.
TARGETED, NEGATED, REPORTED = 1, 2, 4
FACTORS = {TARGETED: 1.5, NEGATED: 0.25, REPORTED: 0.4}
#: Labels of matches: insult or threat, times the marks. A text's features: of each label the clause scores' sum and the
#: greatest clause score, both on a logarithmic scale.
LABELS = 16
FEATURES = 2 * LABELS
#: Clauses whose matches are kept in memory, by their string of classes.
KEPT_CLAUSES = 65_536
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".!?;\n"]] = True
_STEM_SALT = np.uint64(0x5851F42D4C957F2D)


def _hash_words(words: list[str]) -> np.ndarray:
    raw = np.frombuffer(folded(np.frombuffer("\n".join(words).encode(), np.uint8)).tobytes(), np.uint8)
    starts, ends, _ = word_spans(raw, np.array([0, len(raw)]))
    return span_hashes(raw, starts, ends)[0]


def _closed_classes() -> tuple[np.ndarray, np.ndarray]:
    hashes = [_hash_words([w]) for words in (THREATS, TARGETS, NEGATIONS, REPORTS) for w in words]
    kinds = [k for k, words in ((_THREAT, THREATS), (_TARGET, TARGETS), (_NEGATION, NEGATIONS), (_REPORT, REPORTS)) for _ in words]
    h, k = np.array([x[0] for x in hashes]), np.array(kinds)
    h, first = np.unique(h, return_index=True)
    return h, k[first]


def _words(raw: np.ndarray, offsets: np.ndarray):
    """(starts, ends, words per text, hash of each word, hashes of its beginnings of STEMS bytes, 0 where the word is no longer)."""
    # The typographic apostrophe counts as the plain one, which no word holds.
    quote = np.flatnonzero((raw[:-2] == 0xE2) & (raw[1:-1] == 0x80) & (raw[2:] == 0x99)) if len(raw) > 2 else np.zeros(0, np.int64)
    if len(quote):
        raw = raw.copy()
        raw[(quote[:, None] + np.arange(3)).ravel()] = 0x27
    starts, ends, counts = word_spans(raw, offsets, ALNUM)
    whole, total = span_hashes(raw, starts, ends)
    stems = []
    for k in STEMS:
        long = ends - starts > k
        h = np.zeros(len(starts), np.uint64)
        h[long] = mix64(span_hashes(raw, starts[long], starts[long] + k, total)[0] + _STEM_SALT)
        stems.append(h)
    return starts, ends, counts, whole, stems


def _lookup(keys: np.ndarray, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(at), values.dtype)
    k = np.searchsorted(keys, at)
    k[k == len(keys)] = 0
    return np.where(keys[k] == at, values[k], values.dtype.type(0))


# ---------------------------------------------------------------- transducers


class Transducer:
    """A weighted finite-state transducer over the (max, +) semiring.

    arcs: state -> input symbol -> list of (output symbol, weight, next state). A path is accepted if it ends in a final
    state; of several, the one of greatest weight counts, then the one whose states sort first."""

    def __init__(self, start, arcs: dict, final: set):
        self.start, self.arcs, self.final = start, arcs, final

    def paths(self, string: list) -> list[tuple[float, list]]:
        """(weight, output) of every accepted path, tried one by one."""
        live = [(0.0, [], self.start)]
        for symbol in string:
            live = [(w + x, [*out, y], to) for w, out, at in live for y, x, to in self.arcs.get(at, {}).get(symbol, ())]
        return [(w, out) for w, out, at in live if at in self.final]

    def best(self, string: list) -> list | None:
        """The output of the best path, by dynamic programming over the states."""
        live = {self.start: (0.0, None, None)}
        back = []
        for symbol in string:
            after: dict = {}
            for at in sorted(live):
                for y, x, to in self.arcs.get(at, {}).get(symbol, ()):
                    w = live[at][0] + x
                    if to not in after or w > after[to][0]:
                        after[to] = (w, at, y)
            back.append(after)
            live = after
        ends = [(-w, at) for at, (w, _, _) in live.items() if at in self.final]
        if not ends:
            return None
        out, at = [], min(ends)[1]
        for after in reversed(back):
            _, at, y = after[at]
            out.append(y)
        return out[::-1]


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that feeds the first one's output to the second: pairs of states, weights added."""
    start = (first.start, second.start)
    arcs: dict = {}
    pending = [start]
    while pending:
        pair = pending.pop()
        if pair in arcs:
            continue
        a, b = pair
        here: dict = {}
        for x, outs in first.arcs.get(a, {}).items():
            for y, w, a2 in outs:
                for z, v, b2 in second.arcs.get(b, {}).get(y, ()):
                    here.setdefault(x, []).append((z, w + v, (a2, b2)))
                    pending.append((a2, b2))
        arcs[pair] = here
    return Transducer(start, arcs, {p for p in arcs if p[0] in first.final and p[1] in second.final})


#: A symbol is a word class, or a match: 8 + 8 * (it is a threat) + marks.
_MATCHES = list(range(8, 8 + LABELS))
_PLAIN = [_OTHER, _TARGET, _NEGATION, _REPORT]


def lexical() -> Transducer:
    """Insults and threats become matches without marks, the rest stays."""
    arcs = {0: {s: [(s, 0.0, 0)] for s in _PLAIN} | {_INSULT: [(8, 0.0, 0)], _THREAT: [(16, 0.0, 0)]}}
    return Transducer(0, arcs, {0})


def _near_target(reach: int, hit, miss) -> Transducer:
    """The machine that gives a match m the output hit(m) if a target stands within `reach` words of it, else miss(m).

    States 0 to reach: words that a target before still reaches. States -1 to -reach: a target is promised within so many
    words; a path that breaks its promise ends there, and every match of a promise earns one, so that the best path marks
    all matches that can be."""
    arcs: dict = {}
    for state in range(-reach, reach + 1):
        left = max(state - 1, 0)
        here: dict = {_TARGET: [(_TARGET, 0.0, reach)]}
        waits = state + 1  # the promise after one more word; at 0 it is broken
        for s in [_OTHER, _NEGATION, _REPORT]:
            here[s] = [(s, 0.0, left)] if state >= 0 else [(s, 0.0, waits)] * (waits < 0)
        for m in _MATCHES:
            if state > 0:
                here[m] = [(hit(m), 0.0, left)]
            elif state == 0:
                here[m] = [(miss(m), 0.0, 0), (hit(m), 1.0, -reach)]
            else:
                here[m] = [(hit(m), 1.0, waits)] * (waits < 0)
        arcs[state] = here
    return Transducer(0, arcs, set(range(reach + 1)))


def threats() -> Transducer:
    """A threat without a target near it is no match."""
    return _near_target(TARGET_REACH, lambda m: m, lambda m: m if m < 16 else _OTHER)


def targets() -> Transducer:
    return _near_target(TARGET_REACH, lambda m: m | TARGETED, lambda m: m)


def negation() -> Transducer:
    """A match within NEGATION_REACH words after a negation is marked."""
    arcs: dict = {}
    for state in range(NEGATION_REACH + 1):
        left = max(state - 1, 0)
        arcs[state] = {s: [(s, 0.0, left)] for s in (_OTHER, _TARGET, _REPORT)} | {_NEGATION: [(_NEGATION, 0.0, NEGATION_REACH)]}
        arcs[state] |= {m: [(m | NEGATED if state else m, 0.0, left)] for m in _MATCHES}
    return Transducer(0, arcs, set(arcs))


def reports() -> Transducer:
    """Matches after a verb of report are marked up to the clause's end."""
    arcs = {k: {s: [(s, 0.0, k)] for s in (_OTHER, _TARGET, _NEGATION)} | {_REPORT: [(_REPORT, 0.0, 1)]} | {m: [(m | REPORTED if k else m, 0.0, k)] for m in _MATCHES} for k in (0, 1)}
    return Transducer(0, arcs, {0, 1})


def grammar_machine() -> Transducer:
    """All five in a row, as one machine with numbered states."""
    whole = compose(compose(compose(compose(lexical(), threats()), targets()), negation()), reports())
    number = {state: k for k, state in enumerate(whole.arcs)}
    arcs = {number[a]: {x: [(y, w, number[to]) for y, w, to in outs] for x, outs in here.items()} for a, here in whole.arcs.items()}
    return Transducer(number[whole.start], arcs, {number[a] for a in whole.final})


#: Other words after which no machine's state depends on what was before, but for reported speech: longer gaps are as this one.
_GAP = max(NEGATION_REACH, TARGET_REACH) + 1


class Grammar:
    """The composed machine over a learned insult lexicon.

    without: marks that are not told apart (for comparisons)."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, without: int = 0):
        order = np.argsort(keys)
        self.keys, self.weights, self.without = keys[order], weights[order], without
        self.closed, self.kinds = _closed_classes()
        self.machine = grammar_machine()
        self.known: dict[bytes, tuple[tuple[int, int], ...]] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def matches(self, string: bytes) -> tuple[tuple[int, int], ...]:
        """(place, label) of the matches of a clause, given as a string of classes."""
        found = self.known.get(string)
        if found is None:
            if len(self.known) >= KEPT_CLAUSES:
                self.known.clear()
            out = self.machine.best(list(string))
            found = self.known[string] = tuple((k, (y - 8) & ~self.without) for k, y in enumerate(out) if y >= 8)
        return found

    def events(self, raw: np.ndarray, offsets: np.ndarray):
        """(text, clause, place, class, weight) of the words that are not of class other, in clauses with an insult or threat."""
        starts, _, counts, whole, stems = _words(raw, offsets)
        nothing = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0),)
        if not len(starts):
            return nothing
        weight = _lookup(self.keys, self.weights, whole)
        for h in stems:
            weight = np.maximum(weight, _lookup(self.keys, self.weights, h))
        kind = np.where(weight > 0, _INSULT, _lookup(self.closed, self.kinds, whole))
        hot = np.flatnonzero((kind == _INSULT) | (kind == _THREAT))
        if not len(hot):
            return nothing
        # A contraction's parts are words of their own: n't and n' negate.
        for letter, step in ((self._t, -1), (self._n, 1)):
            at = np.flatnonzero((whole == letter) & (kind == _OTHER))
            spot = np.clip(starts[at] + step, 0, len(raw) - 1)
            kind[at[(raw[spot] == 0x27) | (raw[spot] == (0x99 if step < 0 else 0xE2))]] = _NEGATION
        text = np.repeat(np.arange(len(counts)), counts)
        breaks = np.cumsum(_BREAK[raw])
        clause = text * (int(breaks[-1]) + 1) + breaks[starts]
        use = np.flatnonzero((kind != _OTHER) & np.isin(clause, clause[hot]))
        return text[use], clause[use], use, kind[use], np.where(kind[use] == _THREAT, THREAT_WEIGHT, weight[use])

    _t, _n = (int(_hash_words([w])[0]) for w in "tn")

    def features(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """FEATURES numbers for each text of folded bytes, of its clauses' scores alone."""
        out = np.zeros((len(offsets) - 1, FEATURES))
        text, clause, place, kind, weight = self.events(raw, offsets)
        if not len(text):
            return out
        gap = np.zeros(len(text), np.int64)
        gap[1:] = np.minimum(place[1:] - place[:-1] - 1, _GAP)
        cuts = [0, *(np.flatnonzero(np.diff(clause)) + 1).tolist(), len(text)]
        words = [bytes(g) + bytes((k,)) for g, k in zip(gap.tolist(), kind.tolist(), strict=True)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            # bytes(g) is g words of class other; those before the first event change nothing.
            string = bytes((int(kind[a]),)) + b"".join(words[a + 1 : b])
            found = self.matches(string)
            if not found:
                continue
            ends = np.cumsum([1, *(gap[a + 1 : b] + 1).tolist()]) - 1
            score = np.zeros(LABELS)
            for at, label in found:
                score[label] += weight[a + int(np.searchsorted(ends, at))]
            row = out[text[a]]
            row[:LABELS] += score
            np.maximum(row[LABELS:], score, out=row[LABELS:])
        return np.log1p(out)


def prior_weights() -> np.ndarray:
    """What each feature weighs before any row is seen: the product of its marks' factors."""
    by_label = np.array([np.prod([f for mark, f in FACTORS.items() if label & mark]) for label in range(LABELS)])
    return np.concatenate([by_label, by_label])


#: How strongly the weights are held to the grammar's factors (as a ridge), and the intercept before any row is seen.
PRIOR_STRENGTH, PRIOR_INTERCEPT = 1.0, -3.0


class Model:
    """A grammar with the weights that make a probability of its features; beta[0] is the intercept."""

    def __init__(self, grammar: Grammar, beta: np.ndarray):
        self.grammar, self.beta = grammar, beta

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x = self.grammar.features(folded(raw), offsets)
        return 1 / (1 + np.exp(-np.clip(x @ self.beta[1:] + self.beta[0], -30, 30)))


def _newton(x: np.ndarray, y: np.ndarray, prior: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Logistic regression held to a prior; the first column of x is that of the intercept."""
    beta = prior.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(h, x.T @ (y - p) - keep * (beta - prior))
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _logistic(x: np.ndarray, y: np.ndarray, strength: float = PRIOR_STRENGTH) -> np.ndarray:
    """The intercept and the features' weights. First the scales of the two kinds of features, whose labels weigh what the
    grammar's factors say, are fitted; then each label's own weight, held to that: a label that no row has keeps its factor."""
    one, factors = np.ones((len(x), 1)), prior_weights()
    kinds = [factors * (np.arange(FEATURES) < LABELS), factors * (np.arange(FEATURES) >= LABELS)]
    scale = _newton(np.hstack([one, *(x @ k[:, None] for k in kinds)]), y, np.array([PRIOR_INTERCEPT, 1.0, 1.0]), np.array([1e-2, 1e-2, 1e-2]))
    tied = sum(max(w, 0.0) * k for w, k in zip(scale[1:], kinds, strict=True))
    return _newton(np.hstack([one, x]), y, np.concatenate([scale[:1], tied]), np.concatenate([[1e-2], np.full(FEATURES, strength)]))


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Learns from at most `rows` labelled rows that are not held out: three in five give the lexicon, the rest the weights.

    Labels other than 0 and 1, null ids and texts are left out; rows that share an id are one (its least text, its greatest
    label), so that what is gathered is bounded by `rows`. Without rows of both labels the lexicon is empty and the grammar
    keeps its prior weights: threats against a target are all that it knows."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(id_col).agg(F.max(label_col).cast("int").alias("y")).orderBy(F.xxhash64(id_col), id_col).limit(rows)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(known.select(F.col(id_col).alias("id"), "y")), "id")
    sample = sample.filter("text is not null").groupBy("id").agg(F.min("text").alias("text"), F.max("y").alias("y")).select("text", "y", (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(5)) < 3).cast("int").alias("part"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(1).to_numpy()
            for first, raw, offsets in text_slices(batch.column(0)):
                raw = folded(raw)
                _, _, counts, whole, stems = _words(raw, offsets)
                text = np.repeat(np.arange(len(counts)), counts)
                pairs = [np.unique(np.stack([text.astype(np.uint64), h]), axis=1) for h in (whole, *stems)]
                pairs = np.hstack([p[:, p[1] != 0] for p in pairs])
                toxic = y[first + pairs[0].astype(np.int64)] == 1
                keys, at = np.unique(pairs[1], return_inverse=True)
                pos, both = np.bincount(at[toxic], minlength=len(keys)), np.bincount(at, minlength=len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(pos.astype(np.int64)), pa.array((both - pos).astype(np.int64))], names=["key", "pos", "neg"])

    part = sample.filter("part = 1")
    n = {r["y"]: r["n"] for r in part.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos_n, neg_n = n.get(1, 0), n.get(0, 0)
    grams = part.select("text", "y").mapInArrow(count, "key long, pos long, neg long").groupBy("key").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    odds = F.log((F.col("pos") + 0.1) / F.lit(pos_n + 1.0)) - F.log((F.col("neg") + 0.5) / F.lit(neg_n + 1.0))
    least = max(3, round(pos_n * 0.004))
    picked = grams.filter(F.col("pos") >= least).withColumn("w", odds).filter("w > 2.5").orderBy(F.desc("w"), "key").limit(LEXICON).collect()
    grammar = Grammar(np.array([r["key"] for r in picked], np.int64).view(np.uint64), np.array([r["w"] for r in picked], float))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raw, offsets in text_slices(batch.column(0)):
                x = grammar.features(folded(raw), offsets)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(first, len(x)), *(pa.array(c) for c in x.T)], names=["y", *(f"x{k}" for k in range(FEATURES))])

    rest = sample.filter("part = 0").select("text", "y").mapInArrow(measure, "y int, " + ", ".join(f"x{k} double" for k in range(FEATURES))).toPandas()
    rest = rest.sort_values(list(rest.columns)).to_numpy(float)
    y, x = rest[:, 0], rest[:, 1:]
    if not len(y) or y.min() == y.max():
        return Model(Grammar(grammar.keys[:0], grammar.weights[:0]), np.concatenate([[PRIOR_INTERCEPT], prior_weights()]))
    return Model(grammar, _logistic(x, y))


def score(docs: DataFrame, model: Model, text_col: str = "text", column: str = "score") -> DataFrame:
    """docs with one more column: the probability of toxicity. Null and empty texts get the score of a text without words;
    long texts are scored whole; repeated rows score alike. An empty table stays empty. The added column replaces one of its name."""
    fields = docs.drop(column)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.schema) + f", `{column}` double"
    names = [*fields.columns, column]
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.scores(raw, offsets) for _, raw, offsets in text_slices(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(parts) if parts else np.zeros(0))], names=names)

    return fields.mapInArrow(run, schema)
