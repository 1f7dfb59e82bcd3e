"""Language identification by cross-parsing entropy.

Per language a suffix automaton of labelled text is built.  A text is cross-parsed
against it: from the root, follow characters while the match goes on; where it ends,
a phrase ends and the next begins.  The text's cost in a language is its number of
phrases, divided by the number that the language's own unseen text needs at that
length; the language of least cost wins.

A batch of texts is parsed in step, one symbol of every text at a time.  A language's
``DENSE`` most frequent symbols have a table (state x symbol) of transitions; the others,
which only scripts of many letters have, are a sorted list of edges that is searched.  So a
language takes some ten MB, whatever its script and the other languages are.  Texts of any
length are parsed whole, in runs of ``RUN`` symbols; a phrase ends at the end of a run.

Training: a bounded sample of each language, ``SAMPLE_ROWS`` whole distinct texts by
least hash of the text, fewer where they pass ``SAMPLE_CHARS`` characters, but always two
where the language has two.  Every other text is learned, the rest gives the rate of
unseen text; no text is in both.  A language of a single text gets the mean rate of the
others.  Only these texts are sent to the tasks, and every worker builds its automata
once from them.  With more than ``TOTAL_CHARS`` / ``SAMPLE_CHARS`` languages each has an equal
share of ``TOTAL_CHARS`` instead, so the number of languages does not add to the memory.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; ties go
to the language with more labelled rows, then by name; texts without a letter are not
learned from, and a language without others is not learned; of a text above half of
``SAMPLE_CHARS``, which is taken only where a language has fewer than two others, that
half is learned; without any labelled text every prediction is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.words import text_slices

SAMPLE_ROWS = 24
SAMPLE_CHARS = 72_000
TOTAL_CHARS = 4_000_000        # of all languages' samples together
LEAST_CHARS = 2_000            # of one language's, however many languages there are
DENSE = 48                     # symbols of a language with a table of their own
RUN = 1024
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")


class Alphabet:
    """Symbols: 0 for any run of characters that are no letters, then letters of the
    sample (either case alike), and one symbol for every other letter."""

    def __init__(self, texts: list[str]):
        letters = sorted({c for t in texts for c in t.lower() if c.isalpha()})
        self.size = len(letters) + 2
        code = {c: k + 1 for k, c in enumerate(letters)}
        self.table = np.zeros(0x110000, dtype=np.uint8 if self.size < 256 else np.uint16 if self.size < 1 << 16 else np.uint32)
        self.table[[k for k in range(0x110000) if chr(k).isalpha()]] = self.size - 1
        for c, k in code.items():
            self.table[ord(c)] = k
            if len(c.upper()) == 1:
                self.table[ord(c.upper())] = k

    def symbols(self, text: str) -> np.ndarray:
        s = self.table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        keep = np.ones(len(s), dtype=bool)
        keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
        return s[keep]


class Automaton:
    """Transitions of a suffix automaton; state 0 is dead, state 1 the root."""

    def __init__(self, nexts: list[dict[int, int]], symbols: np.ndarray, size: int):
        count = np.bincount(symbols, minlength=size)
        frequent = [int(c) for c in np.argsort(-count, kind="stable")[:DENSE] if count[c]]
        self.width = len(frequent) + 1               # the last column is dead
        self.column = np.full(size, self.width - 1, dtype=np.int32)
        self.column[frequent] = np.arange(len(frequent))
        self.rare = count > 0
        self.rare[frequent] = False
        self.any_rare = bool(self.rare.any())
        self.size = size
        self.flat = np.zeros(len(nexts) * self.width, dtype=np.int32)
        keys, targets = [], []
        column = self.column.tolist()
        for state, row in enumerate(nexts):
            for c, t in row.items():
                if column[c] < self.width - 1:
                    self.flat[state * self.width + column[c]] = t
                else:
                    keys.append(state * size + c)
                    targets.append(t)
        order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.targets = np.array(targets, dtype=np.int32)[order]

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        out = self.flat[states * self.width + self.column[symbols]]
        if self.any_rare:
            at = np.flatnonzero(self.rare[symbols])
            if len(at):
                key = states[at].astype(np.int64) * self.size + symbols[at]
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                out[at] = np.where(self.keys[place] == key, self.targets[place], 0)
        return out

    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.flat, self.column, self.rare, self.keys, self.targets))


def suffix_automaton(symbols: np.ndarray, size: int) -> Automaton:
    """The automaton of all substrings of ``symbols`` (numbers below ``size``)."""
    nexts: list[dict[int, int]] = [{}, {}]
    link, length = [0, 0], [0, 0]
    last = 1
    for c in symbols.tolist():
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in nexts[p]:
            nexts[p][c] = new
            p = link[p]
        if p:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:   # q also ends shorter matches: split them off
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and nexts[p].get(c) == q:
                    nexts[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return Automaton(nexts, symbols, size)


def phrases(automaton: Automaton, runs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Phrases of each run: ``runs`` is (step, run), longest run first."""
    root = 1
    count = np.zeros(runs.shape[1], dtype=np.int32)
    state = np.full(runs.shape[1], root, dtype=np.int32)
    active = np.searchsorted(-lengths, -np.arange(1, runs.shape[0] + 1), "right")
    for step, n in enumerate(active.tolist()):
        c = runs[step, :n]
        s = automaton.step(state[:n], c)
        end = np.flatnonzero(s == 0)
        if len(end):
            # the phrase ended before c, unless c itself is unknown at the root
            count[end] += state[end] != root
            again = automaton.step(np.full(len(end), root, dtype=np.int32), c[end])
            count[end[again == 0]] += 1
            again[again == 0] = root
            s[end] = again
        state[:n] = s
    return count + (state != root)


class Model:
    """Alphabet, automata and own rates, built from the sample in each worker."""

    _built: dict[int, Model] = {}

    def __init__(self, sample: tuple[tuple[str, tuple[str, ...]], ...]):
        self.alphabet = Alphabet([t for _, ts in sample for t in ts])
        self.langs, self.tables, self.rates = [], [], []
        for lang, texts in sample:
            texts = [t for t in dict.fromkeys(texts) if _LETTER.search(t)]
            if not texts:
                continue
            self.langs.append(lang)
            half = suffix_automaton(self._cut(texts[::2]), self.alphabet.size)
            self.tables.append(half)
            # the rate of unseen own text, parsed against the half that is learned
            unseen = self._cut(texts[1::2])
            self.rates.append(max(self._parse(half, [unseen])[0], 1) / len(unseen) if len(unseen) else None)
        rated = [r for r in self.rates if r is not None]
        mean = sum(rated) / len(rated) if rated else 1.0
        self.rates = [mean if r is None else r for r in self.rates]

    @classmethod
    def of(cls, sample) -> Model:
        key = hash(sample)
        if key not in cls._built:
            cls._built.clear()
            cls._built[key] = cls(sample)
        return cls._built[key]

    def _cut(self, texts) -> np.ndarray:
        parts = [self.alphabet.symbols(t + " ") for t in texts]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint8)

    @staticmethod
    def _runs(symbols: list[np.ndarray]):
        owner, cut = [], []
        for i, s in enumerate(symbols):
            for at in range(0, len(s), RUN):
                owner.append(i)
                cut.append(s[at:at + RUN])
        lengths = np.array([len(c) for c in cut], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        runs = np.zeros((int(lengths.max(initial=0)), len(cut)), dtype=symbols[0].dtype if symbols else np.uint8)
        for k, o in enumerate(order.tolist()):
            runs[:len(cut[o]), k] = cut[o]
        return runs, lengths[order], np.array(owner, dtype=np.int64)[order]

    def _parse(self, table, symbols) -> np.ndarray:
        out = np.zeros(len(symbols), dtype=np.int64)
        runs, lengths, owner = self._runs(symbols)
        np.add.at(out, owner, phrases(table, runs, lengths))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t and self.langs and _LETTER.search(t)]
        if known:
            symbols = [self.alphabet.symbols(texts[i]) for i in known]
            runs, lengths, owner = self._runs(symbols)
            costs = np.zeros((len(self.langs), len(known)))
            for k, (table, rate) in enumerate(zip(self.tables, self.rates)):
                np.add.at(costs[k], owner, phrases(table, runs, lengths) / rate)
            best = costs.argmin(axis=0)
            weight = (costs.min(axis=0) / np.maximum(costs, 1e-9)) ** 8
            share = 1 / weight.sum(axis=0)
            for i, k, p in zip(known, best.tolist(), share.tolist()):
                langs[i], scores[i] = self.langs[k], p
        return langs, scores


def sample_texts(labelled: DataFrame, key: str, text: str, lang: str, rows: int = SAMPLE_ROWS,
                 chars: int = SAMPLE_CHARS) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """Of each language's distinct texts with a letter, of at most ``chars`` / 2 characters,
    up to ``rows`` of least hash within ``chars`` characters; the shortest longer ones fill
    up to two.  Most frequent language first; counts are over all rows.  Hashes are made
    distinct by Spark (``key`` only picks between texts of one hash); the driver gets a
    few times the sample's hashes and the sample's texts, however large the table is."""
    known = labelled.where((F.length(text) > 0) & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("l"), F.col(text).alias("t"), F.col(key).alias("k"), F.xxhash64(text).alias("h"))
    # leading zeros of the unsigned hash: level z holds 2^-(z+1) of the texts
    level = F.when(F.col("h") < 0, 0).otherwise(F.lit(64) - F.length(F.regexp_replace(F.bin("h"), "^0+", "")))
    texts = known.groupBy("l", "h").agg(F.count(F.lit(1)).alias("all"), F.max(F.length("t")).alias("n")) \
        .withColumn("fits", F.col("n") <= chars // 2).withColumn("z", level.cast("int")).persist()
    try:
        levels = texts.groupBy("l", "fits", "z").agg(
            F.sum("all").alias("all"), F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n")).collect()
        total: dict[str, int] = {}
        for r in levels:
            total[r["l"]] = total.get(r["l"], 0) + r["all"]
        ordered = sorted(total, key=lambda name: (-total[name], name))
        chars = min(chars, max(LEAST_CHARS, TOTAL_CHARS // max(1, len(ordered))))
        least: dict[str, int] = {}
        for name in ordered:
            held = held_chars = 0
            least[name] = 0
            for r in sorted((r for r in levels if r["l"] == name and r["fits"]), key=lambda r: -r["z"]):
                held, held_chars = held + r["texts"], held_chars + r["n"]
                if held >= rows or held >= 2 and held_chars >= chars:
                    least[name] = r["z"]
                    break
        if not ordered:
            return ()
        from_level = F.create_map(*[F.lit(x) for item in least.items() for x in item])
        near: dict[str, list] = {name: [] for name in ordered}
        for r in texts.where(F.col("fits") & (F.col("z") >= from_level[F.col("l")])).select("l", "h", "n").collect():
            near[r["l"]].append((r["h"] % (1 << 64), r["n"], r["h"]))
        chosen: dict[str, list[int]] = {}
        for name, found in near.items():
            taken, held_chars = [], 0
            for _, n, h in sorted(found)[:rows]:
                if len(taken) >= 2 and held_chars + n > chars:
                    break
                taken.append(h)
                held_chars += n
            chosen[name] = taken
        for _ in range(2):     # languages of long texts: the shortest ones
            lacking = [name for name in ordered if len(chosen[name]) < 2]
            if lacking:
                rest = texts.where(~F.col("fits") & F.col("l").isin(lacking)
                                   & ~F.col("h").isin([h for name in lacking for h in chosen[name]]))
                for r in rest.groupBy("l").agg(F.min(F.struct("n", "h")).alias("m")).collect():
                    chosen[r["l"]].append(r["m"]["h"])
    finally:
        texts.unpersist()
    place = {(name, h): i for name, hs in chosen.items() for i, h in enumerate(hs)}
    got: dict[str, dict[int, str]] = {name: {} for name in ordered}
    wanted = known.where(F.col("h").isin(sorted({h for _, h in place}))).select(
        "l", "h", "k", F.substring("t", 1, chars // 2).alias("t"))
    for r in wanted.groupBy("l", "h").agg(F.min(F.struct("k", "t")).alias("m")).collect():
        if (r["l"], r["h"]) in place:
            got[r["l"]][place[r["l"], r["h"]]] = r["m"]["t"]
    return tuple((name, tuple(mine[i] for i in sorted(mine))) for name, mine in got.items())


def identify(documents: DataFrame, sample, text: str = "text") -> DataFrame:
    """``documents`` plus lang_pred and score (the winner's share, 0 to 1); columns of
    these names are replaced.  Predictions read the text column alone."""
    kept = [f.name for f in documents.schema if f.name not in ("lang_pred", "score")]
    schema = documents.select(*kept).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.of(sample)
        for batch in batches:
            for rows, texts in text_slices(batch, text):
                langs, scores = model.predict([t.decode() if t else None for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in kept), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=[*kept, "lang_pred", "score"])

    return documents.select(*kept).mapInArrow(run, schema)
