"""Language identification by cross-parsing entropy.

Each language is a suffix automaton of a bounded sample of its labelled text. A document is cut
greedily into the longest phrases that occur in that sample; the language whose sample explains
the document in the fewest phrases a byte wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import kept, map_arrow

#: Bytes of a segment, and segments that parse side by side; where they meet, phrases are set right.
SEGMENT, SIDE_BY_SIDE = 2048, 4096
PLAIN_LETTER = re.compile("[A-Za-z]")
UNDETERMINED = "und"
#: A text of so many times its language's usual phrases, and so many more, is in no learned language.
FAR, SPARE = 2.0, 8


def has_letter(text: str) -> bool:
    r"""Whether a text has a character of Unicode's category L, as \p{L} in fit: no number, mark or sign."""
    return PLAIN_LETTER.search(text) is not None or any(map(str.isalpha, text))


def _byte_classes() -> np.ndarray:
    """Bytes that are neither ASCII letters nor part of a non-ASCII character count as a space."""
    classes = np.full(256, 32, np.uint8)
    for b in [*range(ord("a"), ord("z") + 1), *range(128, 256)]:
        classes[b] = b
    return classes


CLASSES = _byte_classes()


def normalise(text: str) -> np.ndarray:
    """Lower-cased UTF-8 bytes, each run of other characters as one space."""
    raw = CLASSES[np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)]
    space = raw == 32
    return raw[~(space & np.concatenate(([False], space[:-1])))] if len(raw) else raw


def suffix_automaton(sample: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of `sample` by state and byte."""
    to: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in sample.tolist():
        cur = len(to)
        to.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in to[p]:
            to[p][c] = cur
            p = link[p]
        if p != -1:
            q = to[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(to)
                to.append(dict(to[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and to[p].get(c) == q:
                    to[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return to


class Automaton:
    """The suffix automaton of a sample as a table over the bytes that it has; columns: the place of each byte, the last for all others."""

    def __init__(self, sample: np.ndarray):
        used = np.unique(sample)
        self.width = len(used) + 1
        self.columns = np.full(256, len(used), np.int16)
        self.columns[used] = np.arange(len(used))
        arcs = suffix_automaton(sample)
        # States as places of their rows, -1 where a string ends its match.
        places = np.repeat(np.arange(len(arcs)) * self.width, [len(x) for x in arcs])
        table = np.full(len(arcs) * self.width, -1, np.int32)
        table[places + self.columns[np.fromiter((c for x in arcs for c in x), np.intp, len(places))]] = np.fromiter((q for x in arcs for q in x.values()), np.int32, len(places)) * self.width
        self.flat, self.start = table, np.maximum(table[: self.width], 0)

    def phrases(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy phrases that begin in each segment, and the state at its end. Rows of `codes` hold columns, longest segment first.

        A byte on which no match goes on starts the next phrase; one that the sample lacks is a
        phrase by itself.
        """
        state, count = np.zeros(len(codes), np.intp), np.zeros(len(codes), np.int32)
        alive = len(codes) - np.cumsum(np.bincount(lengths, minlength=codes.shape[1] + 1))
        for k in range(codes.shape[1]):
            n = alive[k]
            c = codes[:n, k]
            step = self.flat.take(state[:n] + c)
            cut = np.flatnonzero(step < 0)
            step[cut] = self.start[c[cut]]
            # A phrase begins where a match is cut, and in the state of nothing matched.
            count[:n] += state[:n] == 0
            count[cut[state[cut] > 0]] += 1
            state[:n] = step
        return count, state

    def joined(self, segments: list[np.ndarray], counts: list[int], states: list[int]) -> int:
        """Phrases of a text from those of its segments, each parsed from nothing matched.

        The parse that comes in goes on into a segment until both begin a phrase at one byte;
        from there on they agree.
        """
        flat, total, state = self.flat, counts[0], states[0]
        for segment, count, last in zip(segments[1:], counts[1:], states[1:], strict=True):
            other = more = 0
            total += count
            for c in self.columns[segment].tolist() if state else ():
                step, step_other = flat.item(state + c), flat.item(other + c)
                begins, begins_other = state == 0 or step < 0, other == 0 or step_other < 0
                if begins and begins_other:
                    state = last
                    break
                more += begins - begins_other
                state = step if step >= 0 else self.start.item(c)
                other = step_other if step_other >= 0 else self.start.item(c)
            else:  # nothing came in, or the parses do not meet here
                state = state or last
            total += more
        return total


def automata(models: list[tuple[str, bytes]]) -> list[tuple[str, Automaton]]:
    """(name, automaton) of each model, built once for the tasks that use them: a sample is small, its automaton is not."""
    return kept(tuple(models), lambda: [(name, Automaton(np.frombuffer(sample, np.uint8))) for name, sample in models])


def fit(labelled: DataFrame, n_buckets: int = 256, sample_chars: int = 160) -> list[tuple[str, bytes]]:
    """(language, sample) from (doc_id, text, lang) rows, sorted by language.

    The sample of a language is bounded: of each of `n_buckets` buckets of texts, by a hash of
    the text, `sample_chars` characters of the text of least hash, from a place that the hash
    names, or from its first letter where that place has none. That is at most
    n_buckets * sample_chars characters (40,960) a language, gathered with a map-side
    aggregate. Rows with null text or lang, and texts without letters, teach nothing.
    """
    known = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    known = known.select("lang", "text", F.xxhash64("text").alias("h"))
    place = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1) + 1
    part, size = F.substring("text", place.cast("int"), F.lit(sample_chars)), F.lit(sample_chars)
    part = F.when(part.rlike(r"\p{L}"), part).otherwise(F.substring("text", F.regexp_instr("text", F.lit(r"\p{L}")), size))
    known = known.select("lang", "h", part.alias("part"))
    picked = known.groupBy("lang", F.pmod("h", F.lit(n_buckets)).alias("bucket")).agg(F.min_by("part", F.struct("h", "part")).alias("part"))
    parts = picked.groupBy("lang").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "part"))), lambda x: x["part"]), " ").alias("sample"))
    return [(r["lang"], normalise(r["sample"]).tobytes()) for r in parts.orderBy("lang").collect()]


def parse_counts(models: list[tuple[str, Automaton]], texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases by text and language, and the bytes of each text after normalisation.

    Texts are parsed whole. Few segments at a time bound the memory, however many texts there
    are; of a longer text, all segments are held.
    """
    counts, sizes = np.zeros((len(texts), len(models)), np.int64), np.zeros(len(texts), np.int64)

    def count(owner: list[int], parts: list[np.ndarray]) -> None:
        lengths = np.array([len(p) for p in parts])
        order = np.argsort(-lengths, kind="stable")
        found = np.zeros((2, len(models), len(parts)), np.int64)
        for at in range(0, len(parts), SIDE_BY_SIDE):
            some = order[at : at + SIDE_BY_SIDE]
            segments = np.zeros((len(some), int(lengths[some[0]])), np.uint8)
            for row, k in enumerate(some.tolist()):
                segments[row, : lengths[k]] = parts[k]
            for j, (_, model) in enumerate(models):
                found[:, j, some] = model.phrases(np.asfortranarray(model.columns[segments]), lengths[some])
        first = [k for k in range(len(parts)) if not k or owner[k] != owner[k - 1]]
        for a, b in zip(first, [*first[1:], len(parts)], strict=True):
            for j, (_, model) in enumerate(models):
                counts[owner[a], j] = found[0, j, a] if b == a + 1 else model.joined(parts[a:b], found[0, j, a:b].tolist(), found[1, j, a:b].tolist())

    parts: list[np.ndarray] = []
    owner: list[int] = []
    for i, text in enumerate(texts):
        if text:
            raw = normalise(text)
            sizes[i] = len(raw)
            parts += [raw[at : at + SEGMENT] for at in range(0, len(raw), SEGMENT)]
            owner += [i] * (len(parts) - len(owner))
            if len(parts) >= SIDE_BY_SIDE:
                count(owner, parts)
                parts, owner = [], []
    if parts:
        count(owner, parts)
    return counts, sizes


def _slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Few texts at a time become Python's."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


_OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("phrase_rate", pa.float64())])


def identify(documents: DataFrame, models: list) -> DataFrame:
    """(doc_id, lang_pred, score, phrase_rate), a row for each row of `documents` (doc_id, text).

    lang_pred is the language of fewest phrases (ties: the first by name); `und` if the text is
    null or has no letter, or nothing was learned. score is 1 - fewest / second fewest: 0 where
    two languages explain a text alike, and 1 for the only language learned. phrase_rate is the
    fewest phrases a byte. Texts are read whole, of any length; other columns are left alone.
    """
    shared = documents.sparkSession.sparkContext.broadcast(models)

    def parse(batches):
        models = automata(shared.value)
        for batch in _slices(batches):
            texts = batch.column(1).to_pylist()
            texts = [t if t and has_letter(t) and models else None for t in texts]
            counts, sizes = parse_counts(models, texts)
            names, scores, rates = [], [], []
            for text, row, n in zip(texts, counts, sizes, strict=True):
                if text is None:
                    names.append(UNDETERMINED), scores.append(0.0), rates.append(None)
                    continue
                best = int(row.argmin())
                names.append(models[best][0])
                rest = np.delete(row, best)
                scores.append(float(1 - row[best] / rest.min()) if len(rest) and rest.min() else float(not len(rest)))
                rates.append(row[best] / n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())], schema=_OUT)

    return map_arrow(documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), parse, "doc_id long, lang_pred string, score double, phrase_rate double")


def held_out_rates(labelled: DataFrame) -> dict[str, float]:
    """Median phrases a byte of each language's labelled texts (text, lang), under the sample of others.

    Texts are dealt to two halves by their hash; each half is parsed with what the other teaches
    of its language. Every labelled text counts. A language with texts in one half alone has no rate.
    """
    known = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("text", "lang", (F.xxhash64("lang", "text") % 2 == 0).alias("even"))
    taught = [((lang, even), sample) for even in (True, False) for lang, sample in fit(known.where(F.col("even") == even))]
    shared = labelled.sparkSession.sparkContext.broadcast(taught)
    schema = pa.schema([("lang", pa.string()), ("rate", pa.float64())])

    def parse(batches):
        models = dict(automata(shared.value))
        for batch in _slices(batches):
            groups: dict[tuple, list[str]] = {}
            for text, lang, even in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                groups.setdefault((lang, even), []).append(text)
            for (lang, even), texts in groups.items():
                if (lang, not even) in models:
                    counts, sizes = parse_counts([(lang, models[lang, not even])], texts)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(texts), pa.string()), pa.array(counts[:, 0] / sizes)], schema=schema)

    rates = map_arrow(known, parse, "lang string, rate double").groupBy("lang").agg(F.percentile_approx("rate", 0.5).alias("rate"))
    return {r["lang"]: r["rate"] for r in rates.collect()}


def keep_identified(documents: DataFrame, models: list, languages: list[str] | None = None, rates: dict[str, float] | None = None) -> DataFrame:
    """The rows of documents (text and any other columns) whose language is found and, if given, among `languages`.

    With `rates`, those of held_out_rates, a text goes if even its best language explains it
    badly: in more than FAR times the phrases that the language's own texts take, and SPARE more.
    """
    shared = documents.sparkSession.sparkContext.broadcast(models)
    at = documents.columns.index("text")

    def keep(batches):
        models = automata(shared.value)
        most = np.array([FAR * (rates or {}).get(name, np.inf) for name, *_ in models])
        for batch in _slices(batches):
            texts = [t if t and has_letter(t) and models else None for t in batch.column(at).to_pylist()]
            names = [None] * len(texts)
            if models:
                counts, sizes = parse_counts(models, texts)
                best = counts.argmin(axis=1)
                fits = counts.min(axis=1) <= most[best] * np.maximum(sizes, 1) + SPARE
                names = [None if t is None or not ok else models[k][0] for t, k, ok in zip(texts, best, fits, strict=True)]
            yield batch.filter(pa.array([n is not None and (languages is None or n in languages) for n in names], pa.bool_()))

    return map_arrow(documents, keep, documents.schema)
