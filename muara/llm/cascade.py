"""Quality rules as a short-circuit cascade, cheapest rejection first.

Every rule is a function of one whole text. A sample tells each rule's cost and how much it rejects, both behind the
rules that run before it; the rules run in the order of rejection per cost and stop at the first that rejects. The order changes the work only: a
document is kept when no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from muara.llm.common import BLANKS, documents, free_names, map_arrow

# The counted symbols.
SYMBOLS = "#*$%&|<>"

#: Documents of the sample that orders the rules, about.
SAMPLE_ROWS = 2000

_kinds = bytes(0x20 if chr(b) in BLANKS else 0x61 if chr(b).isalpha() and b < 128 or b >= 128 else 0x2E for b in range(256))


class Measures:
    """Counts of one text, each made when a rule first asks for it."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self._known: dict[str, object] = {}

    def __getattr__(self, name: str):
        known = self.__dict__["_known"]
        if name not in known:
            known[name] = getattr(type(self), f"_{name}")(self)
        return known[name]

    def _data(self) -> bytes:
        return self.text.encode()

    def _words(self) -> list[bytes]:
        return self.data.split()

    def _n_words(self) -> int:
        return len(self.words)

    def _word_chars(self) -> int:
        return len(self.text) - sum(self.text.count(b) for b in BLANKS)

    def _n_symbols(self) -> int:
        return sum(self.text.count(s) for s in SYMBOLS)

    def _lines(self) -> list[bytes]:
        return [line for line in self.data.split(b"\n") if line.strip()]

    def _n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    def _n_repeat_words(self) -> int:
        if self.n_words < 4:
            return 0
        numbers: dict[bytes, int] = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in self.words], np.int64)
        pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1].astype(np.int64)
        triples = pairs[:-1] * len(numbers) + ids[2:]
        _, place, count = np.unique(triples, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(count[place] > 1)
        covered = np.zeros(len(ids), bool)
        for shift in range(3):
            covered[starts + shift] = True
        return int(covered.sum())

    def _n_letter_words(self) -> int:
        return sum(b"a" in word for word in self.data.translate(_kinds).split())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


#: The two rules of the contract's ``base_failed``.
BASE_RULES = (
    Rule("few_words", lambda m: m.n_words < 50),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
)
#: A symbol for every tenth word; half the lines seen before; words of under 3 or over 12 characters on average;
#: a fifth of the words without a letter.
OWN_RULES = (
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("repeated_lines", lambda m: 2 * m.n_dup_lines > len(m.lines)),
    Rule("word_length", lambda m: not 3 * m.n_words <= m.word_chars <= 12 * m.n_words),
    Rule("letterless_words", lambda m: 5 * m.n_letter_words < 4 * m.n_words),
)


class Timed(Measures):
    """Measures that also tell what each of them cost without the others, and what it was made from."""

    def __init__(self, text: str | None):
        super().__init__(text)
        self.spent: dict[str, int] = {}
        self.uses: set[tuple[str, str]] = set()
        self.open: list[str] = []
        self.inner = [0]

    def __getattr__(self, name: str):
        self.uses.add((self.open[-1], name))
        known = self.__dict__["_known"]
        return known[name] if name in known else self.timed(name, lambda: super(Timed, self).__getattr__(name))

    def timed(self, name: str, work: Callable[[], object]):
        self.open.append(name)
        self.inner.append(0)
        start = time.perf_counter_ns()
        result = work()
        took = time.perf_counter_ns() - start
        self.spent[name] = took - self.inner.pop()
        self.inner[-1] += took
        self.open.pop()
        return result


def _owner(rule: int) -> str:
    return f"rule {rule}"


def rule_order(
    docs: DataFrame,
    rules: Sequence[Rule],
    before: Sequence[Rule] = (),
    made: Sequence[str] = (),
    sample_rows: int = SAMPLE_ROWS,
) -> list[Rule]:
    """Rules by estimated rejections per second, most first; ties and an empty sample keep the given order.

    Each place goes to the rule that rejects most per second of the documents that come so far; measures that the rules
    ahead of it have made, those of ``before`` and those in ``made`` included, cost nothing more.

    The sample is measured where its rows are. To the driver comes a row for each measure and each set of rules that
    reject a document together.
    """
    total = docs.count()
    part = docs.select("text").sample(min(1.0, sample_rows / total), 7) if total else docs.select("text").limit(0)
    every = [*before, *rules]

    def measure(batches):
        import pyarrow as pa

        spent: dict[tuple[int, str, str], int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                m = Timed(text)
                m.timed("made", lambda: [getattr(m, name) for name in made])  # noqa: B023
                hits = [m.timed(_owner(k), lambda: rule.rejects(m)) for k, rule in enumerate(every)]  # noqa: B023
                mask = sum(1 << k for k, hit in enumerate(hits) if hit)
                for owner, n in [("", 1), *m.spent.items()]:
                    spent[mask, owner, ""] = spent.get((mask, owner, ""), 0) + n
                spent.update({(0, owner, used): 0 for owner, used in m.uses})
        keys = list(zip(*spent, strict=True)) or [(), (), ()]
        kinds = (pa.int64(), pa.string(), pa.string())
        columns = [pa.array(k, kind) for k, kind in zip(keys, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(list(spent.values()), pa.int64())], names=["mask", "owner", "used", "n"])

    found = map_arrow(part, measure, "mask long, owner string, used string, n long").groupBy("mask", "owner", "used").agg(F.sum("n").alias("n"))
    rows = [tuple(r) for r in found.collect()]
    order = cheapest_first(
        len(every),
        {mask: n for mask, owner, _, n in rows if not owner},
        {(mask, owner): n for mask, owner, used, n in rows if owner and not used},
        {(owner, used) for _, owner, used, _ in rows if used},
        len(before),
    )
    return [every[k] for k in order]


def cheapest_first(n_rules: int, documents: dict[int, int], spent: dict[tuple[int, str], int], uses: set[tuple[str, str]], first: int = 0) -> list[int]:
    """The rules after the ``first`` ones in the order of rejections per cost, given all that runs before each.

    ``documents`` counts the sample by the set of rules that reject (a bit for each), ``spent`` is the time by set and
    measure, ``uses`` the measures that a measure or rule is made from.
    """

    def needs(owner: str) -> set[str]:
        reached, waiting = {owner}, [owner]
        while waiting:
            at = waiting.pop()
            new = {used for by, used in uses if by == at} - reached
            reached |= new
            waiting += new
        return reached

    needed = [needs(_owner(k)) for k in range(n_rules)]
    known = needs("made").union(*needed[:first])
    gone, order, rest = (1 << first) - 1, [], list(range(first, n_rules))
    while rest:
        alive = [mask for mask in documents if not mask & gone]

        def worth(rule: int) -> float:
            cost = sum(spent.get((mask, owner), 0) for mask in alive for owner in needed[rule] - known)  # noqa: B023
            return sum(documents[mask] for mask in alive if mask >> rule & 1) / max(1, cost)  # noqa: B023

        best = max(rest, key=lambda k: (worth(k), -k))
        order.append(best)
        rest.remove(best)
        gone |= 1 << best
        known = known | needed[best]
    return order


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality(docs: DataFrame, counts: bool = True) -> DataFrame:
    """Each row of ``docs`` with ``kept``; with ``counts`` also the base counts and ``base_failed``.

    Null text has no words and fails ``few_words``. Repeated rows and equal or null ids are judged row by row.
    Other columns pass through; columns with the names of the new ones are replaced.
    """
    base = list(BASE_RULES)
    own = rule_order(docs, OWN_RULES, base, COUNTS) if counts else rule_order(docs, [*base, *OWN_RULES])
    added = [(c, "long") for c in COUNTS] * counts + [("base_failed", "boolean")] * counts + [("kept", "boolean")]
    kept_columns = [c for c in docs.columns if c.lower() not in {n for n, _ in added}]
    text_at = kept_columns.index("text")
    source = docs.select(*[F.col(f"`{c}`") for c in kept_columns])

    def emit(batches):
        import pyarrow as pa

        for batch in batches:
            out: dict[str, list] = {n: [] for n, _ in added}
            for text in batch.column(text_at).to_pylist():
                m = Measures(text)
                failed = counts and any(r.rejects(m) for r in base)
                if counts:
                    for c in COUNTS:
                        out[c].append(getattr(m, c))
                    out["base_failed"].append(failed)
                out["kept"].append(not failed and not any(r.rejects(m) for r in own))
            new = [pa.array(out[n], pa.int64() if kind == "long" else pa.bool_()) for n, kind in added]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *out])

    schema = StructType([*source.schema.fields, *(StructField(n, LongType() if k == "long" else BooleanType()) for n, k in added)])
    return map_arrow(source, emit, schema)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows that no rule rejects, with their columns as they are."""
    (own,) = free_names(docs, "own_kept")
    renamed = {c: own if c.lower() == "kept" else c for c in docs.columns}
    found = quality(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in renamed.items()]), counts=False)
    return found.where("kept").select(*[F.col(f"`{n}`").alias(c) for c, n in renamed.items()])


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text")
    return quality(docs).select("doc_id", *COUNTS, "base_failed", "kept")
