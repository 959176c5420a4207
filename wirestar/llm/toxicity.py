"""Toxicity by a weighted finite-state grammar over clauses.

Five weighted transducers read the words of a clause as symbols. Those of insults and of threats
mark one telling word as the head of a reading, at that word's weight. Those of negation, targets
and reported speech weigh a reading by where their words stand: a negation up to ``REACH`` words
before the head, a target before or after it (an insult's comes first, "you idiot", a threat's
last, "kill you", and a threat without one is no reading), a reporting verb before or after it.
They are composed once into a single machine. A clause's score is the sum of the weights of all
its readings, found in one pass that keeps the weight so far of each state; so a clause is scored
as a whole, never a word alone. A document is scored by its clauses through a logistic curve.

The words of the insult transducer are learned: stems (word beginnings) that stand in toxic
labelled texts, in several different contexts, and hardly in clean ones. Those of the other four
are fixed lists in four languages. The scan for stems is an Aho-Corasick automaton, so a text without any is
read once at its speed; only clauses around a hit are parsed, each whole and once, however long.

Learning uses a bounded sample: ``SAMPLE`` labelled documents, least hashed ids first, from
rows whose crc32 of the id is not held out. A document's labels count as toxic if any is; of an
id with several texts the least one teaches.

Nulls: a null text counts as empty and scores as a text without matches; null labels and ids
teach nothing. Repeated rows are scored each. Without labels the fixed insults alone apply. An
empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import functools
import math
import re
from collections import defaultdict
from collections.abc import Callable, Hashable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from wirestar.llm.common import free_name, frugal, id_remainder, text_or_empty
from wirestar.sources.staging import Staging

SAMPLE = 9_000
FOLDS, HELD_OUT = 3, 1
STEM_LENGTHS = (3, 4, 5, 6, 7, 8)
#: Different contexts (words before and after) that a learned stem needs.
LEAST_CONTEXTS = 5
#: Log of how much likelier toxic documents have a stem than clean ones; and by how much more
#: a longer stem must tell than a chosen beginning of it.
LEAST_WEIGHT, NESTED_GAIN = 3.0, 0.7
SAME_WORD = 0.95
#: The curve is set on one part in CALIBRATION of the sample, which teaches no stems; there a
#: clean document over the threshold costs as much as FALSE_ALARM toxic ones under it.
CALIBRATION, FALSE_ALARM = 4, 4
#: Stems that a task counts before it passes them on.
COUNTED = 200_000
THRESHOLD = 0.7

# Word lists. A trailing * stands for any ending.
INSULTS = (
    "idiot* moron* stupid* scum* loser* trash worthless pathetic disgusting clown* imbecile*"
    " dumb dumbass* bastard* bitch* asshole* idiota* imbécil* estúpid* connard* salaud* crétin*"
    " abruti* dummkopf* trottel* vollidiot* arschloch* abschaum"
).split()
THREATS = (
    "kill* murder* strangle* hurt beat stab* shoot* matar* mataré tuer* frapper* umbringen"
    " erschieß* töten"
).split()
TARGETS = (
    "you your yours he she him her they them tu te toi vous il elle ils du dich dir ihr sie er"
    " tú ti usted ustedes él ella ellos"
).split()
NEGATIONS = (
    "not no never n't isn't aren't don't wasn't pas jamais non nicht kein keine niemals nunca"
).split()
REPORTS = (
    "said says say called calls claimed claims wrote reported quoted dit disait affirme sagte"
    " sagt behauptet schrieb dijo dice afirmó"
).split()

#: Words after a negation that it still reaches.
REACH = 3
NEGATED = 0.5
INSULT_AT = {"nobody": 1.0, "before": 1.5, "after": 1.25}
THREAT_AT = {"before": 0.75, "after": 1.5}
REPORTED = {"before": 0.6, "after": 0.8}
THREAT_WEIGHT, BUILT_IN_WEIGHT, MOST_WEIGHT = 2.0, 4.0, 8.0

_FOUND = (
    StructType().add("score", DoubleType()).add("evidence", DoubleType()).add("clauses", LongType())
)
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_CLAUSE_ENDS = ".!?;:\n"
_CLAUSE_END = re.compile(f"[{_CLAUSE_ENDS}]")


@dataclass(frozen=True)
class Model:
    """``stems``: (beginning, weight) of learned insults. The logistic curve over the log of a
    document's clause sum has ``slope`` and ``bias``."""

    stems: tuple[tuple[str, float], ...] = ()
    slope: float = 4.0
    bias: float = -3.0


# --- transducers ----------------------------------------------------------------------------

#: What a word is, as bits of its symbol; the last two are set by a transducer on a head.
NEGATION, TARGET, REPORT, INSULT, THREAT, INSULT_HEAD, THREAT_HEAD = (1 << i for i in range(7))
HEAD = INSULT_HEAD | THREAT_HEAD
_WORDS = range(INSULT_HEAD)
_MARKED = [x for x in range(THREAT_HEAD << 1) if x & HEAD != HEAD]

#: Of a state and a symbol: the next states, the symbols written, and the weights.
Moves = Callable[[Hashable, int], Iterable[tuple[Hashable, int, float]]]


@dataclass(frozen=True)
class Transducer:
    """Arcs (state, symbol) -> (next state, symbol written, weight), and the weight of ending in
    a state. A state that is not in ``ends`` accepts nothing."""

    start: Hashable
    arcs: dict[tuple[Hashable, int], tuple[tuple[Hashable, int, float], ...]]
    ends: dict[Hashable, float]

    @staticmethod
    def of(
        start: Hashable, moves: Moves, end: Callable[[Hashable], float], symbols: Iterable[int]
    ) -> Transducer:
        """All states that ``moves`` reaches from ``start``; an end of weight 0 is none."""
        arcs, found, open_states = {}, {start}, [start]
        while open_states:
            state = open_states.pop()
            for symbol in symbols:
                out = tuple(moves(state, symbol))
                if out:
                    arcs[state, symbol] = out
                fresh = {to for to, _, _ in out} - found
                found |= fresh
                open_states += fresh
        return Transducer(start, arcs, {x: end(x) for x in found if end(x)})

    def then(self, other: Transducer, symbols: Iterable[int] = _WORDS) -> Transducer:
        """The composition: ``other`` reads what this one writes, and weights multiply."""

        def moves(pair, symbol):
            for p, written, w in self.arcs.get((pair[0], symbol), ()):
                for q, out, v in other.arcs.get((pair[1], written), ()):
                    yield (p, q), out, w * v

        def end(pair):
            return self.ends.get(pair[0], 0.0) * other.ends.get(pair[1], 0.0)

        return Transducer.of((self.start, other.start), moves, end, symbols)


def insult_transducer() -> Transducer:
    """Passes words on, and may mark one insult as the head."""

    def moves(taken, x):
        yield taken, x, 1.0
        if x & INSULT and not taken:
            yield True, x | INSULT_HEAD, 1.0

    return Transducer.of(False, moves, lambda _: 1.0, _WORDS)


def threat_transducer() -> Transducer:
    """Marks one threat as the head unless an insult is; a reading has just one head."""

    def moves(taken, x):
        if not x & HEAD:
            yield taken, x, 1.0
            if x & THREAT and not taken:
                yield True, x | THREAT_HEAD, 1.0
        elif not taken:
            yield True, x, 1.0

    return Transducer.of(False, moves, float, _MARKED)


def negation_transducer() -> Transducer:
    """The state is how many more words a negation reaches, or -1 behind the head."""

    def moves(left, x):
        if left >= 0 and x & HEAD:
            yield -1, x, NEGATED if left or x & NEGATION else 1.0
        elif left >= 0:
            yield REACH if x & NEGATION else max(left - 1, 0), x, 1.0
        else:
            yield left, x, 1.0

    return Transducer.of(0, moves, lambda _: 1.0, _MARKED)


def target_transducer() -> Transducer:
    """The state is where a target stands, as seen from the head once that is read."""

    def moves(state, x):
        head, at = state
        if not head and x & HEAD:
            head = x & HEAD
        if x & TARGET and head == THREAT_HEAD and state[0]:
            at = "after"
        elif x & TARGET and at == "nobody":
            at = "after" if state[0] else "before"
        yield (head, at), x, 1.0

    def end(state):
        return {0: {}, INSULT_HEAD: INSULT_AT, THREAT_HEAD: THREAT_AT}[state[0]].get(state[1], 0.0)

    return Transducer.of((0, "nobody"), moves, end, _MARKED)


def report_transducer() -> Transducer:
    """The state is whether the head is read, and where the first reporting verb stands."""

    def moves(state, x):
        behind, at = state
        if x & REPORT and not at:
            at = "after" if behind else "before"
        yield (behind or bool(x & HEAD), at), x, 1.0

    return Transducer.of((False, ""), moves, lambda state: REPORTED.get(state[1], 1.0), _MARKED)


@functools.cache
def clause_machine() -> Transducer:
    """All five composed, with numbers as states."""
    machine = insult_transducer().then(threat_transducer()).then(negation_transducer())
    machine = machine.then(target_transducer()).then(report_transducer())
    number = defaultdict(lambda: len(number))
    arcs = {
        (number[state], symbol): tuple((number[to], out, w) for to, out, w in moves)
        for (state, symbol), moves in machine.arcs.items()
    }
    ends = {number[state]: w for state, w in machine.ends.items()}
    return Transducer(number[machine.start], arcs, ends)


class Grammar:
    """The composed transducers with the words of a model."""

    def __init__(self, model: Model):
        import ahocorasick

        self.model = model
        self.insults = {s: (w, False) for s, w in model.stems}
        for word in INSULTS:
            self.insults.setdefault(word.rstrip("*"), (BUILT_IN_WEIGHT, not word.endswith("*")))
        self.threats = {w.rstrip("*"): (THREAT_WEIGHT, not w.endswith("*")) for w in THREATS}
        self.lengths = sorted({len(s) for s in (*self.insults, *self.threats)})
        self.targets, self.negations, self.reports = set(TARGETS), set(NEGATIONS), set(REPORTS)
        self.scan = ahocorasick.Automaton()
        for stem in (*self.insults, *self.threats):
            self.scan.add_word(stem, len(stem))
        self.scan.make_automaton()

    def _weight(self, table: dict[str, tuple[float, bool]], word: str) -> float:
        best = 0.0
        for n in self.lengths:
            weight, exact = table.get(word[:n], (0.0, False))
            if weight > best and len(word) >= n and not (exact and len(word) > n):
                best = weight
        return best

    def clauses(self, text: str) -> Iterator[tuple[int, int]]:
        """Spans of the clauses of lower-case ``text`` in which a stem begins a word."""
        done = 0
        for last, n in self.scan.iter(text):
            at = last - n + 1
            if at < done or (at and text[at - 1].isalpha()):
                continue
            begin = max(done, *(text.rfind(end, done, at) + 1 for end in _CLAUSE_ENDS))
            stop = _CLAUSE_END.search(text, at)
            done = stop.start() if stop else len(text)
            yield begin, done

    def read(self, word: str) -> tuple[int, float]:
        """The symbol of a lower-case word, and its weight as a head."""
        symbol = NEGATION * (word in self.negations or word.endswith("n't"))
        symbol |= TARGET * (word in self.targets) | REPORT * (word in self.reports)
        if weight := self._weight(self.insults, word):
            return symbol | INSULT, weight
        weight = self._weight(self.threats, word)
        return symbol | THREAT * (weight > 0), weight

    def clause_score(self, clause: str) -> float:
        """Sum of the weights of all readings."""
        machine = clause_machine()
        weights = {machine.start: 1.0}
        for found in _WORD.finditer(clause):
            symbol, weight = self.read(found[0])
            following: dict[int, float] = {}
            for state, so_far in weights.items():
                for to, out, w in machine.arcs.get((state, symbol), ()):
                    more = so_far * w * (weight if out & HEAD else 1.0)
                    following[to] = following.get(to, 0.0) + more
            weights = following
        return sum(w * machine.ends.get(state, 0.0) for state, w in weights.items())

    def evidence(self, text: str) -> tuple[float, int]:
        """Sum of clause scores, and how many clauses matched."""
        text = text.lower()
        scores = [self.clause_score(text[a:b]) for a, b in self.clauses(text)]
        return sum(scores), sum(s > 0 for s in scores)

    def score(self, evidence: float) -> float:
        x = self.model.slope * math.log1p(evidence) + self.model.bias
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


@functools.lru_cache(maxsize=4)
def grammar(model: Model) -> Grammar:
    return Grammar(model)


# --- learning -------------------------------------------------------------------------------


def labelled_sample(docs: DataFrame, labels: DataFrame, staging: Staging, most: int = SAMPLE) -> DataFrame:
    """(doc_id, text, toxic) of at most ``most`` documents that are not held out."""
    kept = labels.where("doc_id is not null and toxic is not null")
    kept = kept.where(id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
    kept = kept.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    kept = kept.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    sample = texts.join(F.broadcast(kept), "doc_id")  # of an id that repeats, the least text
    sample = sample.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return staging.write(sample, "sample").df


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each stem with each of its contexts, once per batch."""
    for batch in batches:
        found = set()
        for text in batch["text"]:
            words = _WORD.findall(text.as_py().lower())
            for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                context = hash_of(before + " " + after)
                found.update((word[:n], context) for n in STEM_LENGTHS if len(word) >= n)
        stems, contexts = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(stems, pa.string()), pa.array(contexts, pa.int64())], names=["stem", "context"]
        )


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many clean and toxic texts each stem stands; a full memory is passed on."""
    counts: dict[str, list[int]] = {}

    def rows() -> pa.RecordBatch:
        columns = list(zip(*((s, *c) for s, c in counts.items()))) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()))],
            names=["stem", "clean", "toxic"],
        )

    for batch in batches:
        for text, label in zip(batch["text"], batch["toxic"].to_pylist()):
            words = set(_WORD.findall(text.as_py().lower()))
            for stem in {w[:n] for w in words for n in STEM_LENGTHS if len(w) >= n}:
                counts.setdefault(stem, [0, 0])[label == 1] += 1
            if len(counts) > COUNTED:
                yield rows()
                counts.clear()
    yield rows()


def hash_of(text: str) -> int:
    from zlib import adler32, crc32

    data = text.encode()
    return crc32(data) << 31 ^ adler32(data)


def learn(docs: DataFrame, labels: DataFrame, staging: Staging, most: int = SAMPLE) -> Model:
    """Stems and curve from a bounded sample. All stems are counted and weighed in Spark; only
    counts of those that tell reach the driver."""
    sample = labelled_sample(docs, labels, staging, most)
    own = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(CALIBRATION)) == 0
    unseen, sample = sample.where(own), sample.where(~own)
    toxic = sample.where("toxic = 1").select("text")
    contexts = toxic.mapInArrow(frugal(_contexts), "stem string, context long").distinct()
    candidates = contexts.groupBy("stem").agg(F.count("*").alias("contexts"))
    candidates = candidates.where(F.col("contexts") >= LEAST_CONTEXTS).select("stem")
    by_label = sample.groupBy((F.col("toxic") == 1).alias("toxic")).count()
    totals = {r.toxic: r["count"] for r in by_label.collect()}
    clean_total, toxic_total = totals.get(False, 0), totals.get(True, 0)
    counted = sample.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(
        frugal(_occurrences), "stem string, clean long, toxic long"
    )
    counted = counted.groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # A stem that as good as always begins one longer stem is as strong as that one up to this
    # factor, so all that choose_stems compares with are here.
    weight = F.log((F.col("toxic") + 0.5) / (toxic_total + 1)) - F.log((F.col("clean") + 0.5) / (clean_total + 1))
    strong = (F.col("toxic") >= LEAST_CONTEXTS) & (weight >= LEAST_WEIGHT + math.log(SAME_WORD) - 1e-6)
    strong = counted.where(strong).join(candidates, "stem")
    stems = choose_stems(
        [(r.stem, r.clean, r.toxic) for r in strong.collect()],  # telling stems alone
        clean_total, toxic_total,
    )
    return set_curve(unseen, Model(stems))


def choose_stems(
    counts: list[tuple[str, int, int]], clean_total: int, toxic_total: int
) -> tuple[tuple[str, float], ...]:
    """Stems of enough toxic documents and hardly any clean one, with the log of how much
    likelier a toxic document has them. A stem that begins with a chosen one needs to tell
    clearly more."""
    if not clean_total or not toxic_total:
        return ()
    chosen: dict[str, float] = {}
    longer = defaultdict(int)  # toxic documents of the commonest stem one letter longer
    for stem, _, toxic in counts:
        longer[stem[:-1]] = max(longer[stem[:-1]], toxic)
    for stem, clean, toxic in sorted(counts, key=lambda c: (len(c[0]), c[0])):
        rate = (clean + 0.5) / (clean_total + 1)
        weight = min(math.log((toxic + 0.5) / (toxic_total + 1) / rate), MOST_WEIGHT)
        covered = max((chosen.get(stem[:n], 0.0) for n in range(1, len(stem))), default=0.0)
        if longer[stem] >= SAME_WORD * toxic:
            continue  # as good as always the beginning of one longer stem
        if toxic >= LEAST_CONTEXTS and weight >= LEAST_WEIGHT and weight > covered + NESTED_GAIN:
            chosen[stem] = round(weight, 4)
    return tuple(sorted(chosen.items()))


def set_curve(sample: DataFrame, model: Model) -> Model:
    """The curve that reaches the threshold at the best evidence to part the labels by: in the
    middle, on a log scale, of the gap below the least evidence that counts as toxic."""
    scored = with_evidence(sample, model)
    counted = scored.groupBy(F.round(F.log1p("_found.evidence"), 2).alias("x")).agg(
        F.sum((F.col("toxic") == 1).cast("long")).alias("toxic"),
        F.sum((F.col("toxic") != 1).cast("long")).alias("clean"),
    )
    bins = sorted((r.x, r.toxic, r.clean) for r in counted.collect())  # hundredths
    if not sum(b[1] for b in bins):
        return model
    best, least, won = 0, None, 0
    for x, toxic, clean in reversed(bins):
        won += toxic - FALSE_ALARM * clean
        if won > best and x > 0:
            best, least = won, x
    if least is None:
        return model
    under = max((x for x, _, _ in bins if x < least), default=0.0)
    bias = math.log(THRESHOLD / (1 - THRESHOLD)) - model.slope * (under + least) / 2
    return Model(model.stems, model.slope, bias)


# --- scoring --------------------------------------------------------------------------------


def with_evidence(docs: DataFrame, model: Model, name: str = "_found") -> DataFrame:
    """``docs`` with a struct of this ``name``: each text's score, evidence and number of
    matched clauses. Only texts go to Python and only these numbers come back."""
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        rules = grammar(model)
        for texts in batches:
            evidence = [rules.evidence(text.as_py()) for text in texts]
            yield pa.StructArray.from_arrays(
                [pa.array([rules.score(e) for e, _ in evidence], pa.float64()),
                 pa.array([e for e, _ in evidence], pa.float64()),
                 pa.array([n for _, n in evidence], pa.int64())],
                names=["score", "evidence", "clauses"],
            )

    @F.arrow_udf(_FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return frugal(scored)(batches)

    return docs.withColumn(name, found(text_or_empty()))


def score_documents(docs: DataFrame, labels: DataFrame, staging: Staging) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, evidence, clauses."""
    model = learn(docs, labels, staging)
    held_out = F.coalesce(id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return with_evidence(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out.alias("held_out"),
        "_found.score",
        (F.col("_found.score") >= THRESHOLD).cast("int").alias("predicted"),
        "_found.evidence",
        "_found.clauses",
    )


def reject_toxic(docs: DataFrame, labels: DataFrame, staging: Staging) -> DataFrame:
    """Rows of ``docs`` that score below the threshold, with all their columns."""
    model = learn(docs, labels, staging)
    found = free_name(docs, "_found")
    scored = with_evidence(docs, model, found)
    return scored.where(F.col(found)["score"] < THRESHOLD).drop(found)
