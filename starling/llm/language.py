"""Language identification by cross-parsing: fewest normalised phrases out of a language's text."""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch_of

# Symbols of the automata: 0 is what no training text holds, 1 is any run of non-letters.
_OTHER, _GAP = 0, 1
# Texts are parsed in blocks of so many symbols side by side, at first as if each began a phrase; then
# blocks that a phrase runs into are parsed again from where it stands, until nothing changes.
_BLOCK = 2048
# After so many rounds only a text's first open block goes on, whose start is settled: a text whose
# phrases never fall into step costs two passes more, and not one for each of its blocks.
_ROUNDS = 6
# Symbols parsed together, which bounds a task's memory whatever the length of a text.
_TOGETHER = 1 << 22

_OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
_OUT_SQL = "doc_id long, lang_pred string, score double"


def _sample(docs: DataFrame, rows: int, total: int, longest: int) -> dict[str, str]:
    """Whole training texts by language: of some buckets of ids each gives its lowest-hashed document.

    Partial aggregation takes them, so no language's rows meet in one place.
    """
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0").select(
        F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id", F.lit(3)).alias("hash"), "text"
    )
    size = F.length("text")
    shortest = {lang: n for lang, n in known.groupBy("lang").agg(F.min(size)).collect()}
    if not shortest:
        return {}
    buckets = min(rows, max(2, total // len(shortest)))
    texts: dict[str, list[str]] = {lang: [] for lang in shortest}
    drawn = known.where(size <= longest).groupBy("lang", F.pmod("hash", F.lit(buckets)).alias("bucket"))
    for lang, _, text in sorted(map(tuple, drawn.agg(F.min_by("text", "hash").alias("text")).collect())):
        texts[lang].append(text)
    # A language of longer texts only is learned from its shortest.
    for lang in (lang for lang, n in shortest.items() if n > longest):
        one = known.where((F.col("lang") == lang) & (size == shortest[lang])).agg(F.min_by("text", "hash"))
        texts[lang].append(one.first()[0])
    return {lang: "\n".join(parts) for lang, parts in texts.items()}


@dataclass(frozen=True)
class LanguageModel:
    """Training text by language; automata are built from it where they are used."""

    texts: tuple[tuple[str, str], ...]
    symbols: int = 62

    @property
    def key(self) -> str:
        return hashlib.sha256(repr((self.texts, self.symbols)).encode()).hexdigest()


def learn_languages(
    docs: DataFrame, rows: int = 24, total: int = 768, longest: int = 4000, symbols: int = 62
) -> LanguageModel:
    """A model of the languages named in ``docs`` (``doc_id, text, lang``).

    The bound of the fit is ``rows`` documents a language, fewer (but two) where there are so many
    languages that this made more than ``total``. They are read whole, and drawn from those of at most
    ``longest`` characters; a language that has none such is learned from its shortest text. Every
    letter of a text counts; a language's ``symbols`` most frequent ones are looked up in a table,
    its others in a sorted list. Rows without text or language are left out; without any, every
    prediction is ``und``.
    """
    return LanguageModel(tuple(sorted(_sample(docs, rows, total, longest).items())), symbols)


def _transitions(symbols: list[int]) -> list[dict[int, int]]:
    """The smallest automaton that accepts all substrings: each state's next states by symbol."""
    size = 2 * max(1, len(symbols))
    link, length = [-1] * size, [0] * size
    last, states = 0, 1
    out: list[dict[int, int]] = [{}]
    for symbol in symbols:
        new = states
        states += 1
        length[new] = length[last] + 1
        out.append({})
        p = last
        while p != -1 and symbol not in out[p]:
            out[p][symbol] = new
            p = link[p]
        if p == -1:
            link[new] = 0
        else:
            q = out[p][symbol]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = states
                states += 1
                length[clone] = length[p] + 1
                out.append(dict(out[q]))
                link[clone] = link[q]
                while p != -1 and out[p].get(symbol) == q:
                    out[p][symbol] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return out


def suffix_automaton(symbols: list[int], alphabet: int) -> np.ndarray:
    """Transitions of the smallest automaton that accepts all substrings: a row per state, -1: none."""
    out = _transitions(symbols)
    step = np.full((len(out), alphabet), -1, dtype=np.int32)
    for state, edges in enumerate(out):
        for symbol, target in edges.items():
            step[state, symbol] = target
    return step


class CrossParser:
    """Counts, for many texts at once, the phrases that each language's automaton cuts them into.

    A phrase is the longest match with the language's training text from where the last one ended;
    a symbol that the language lacks is a phrase of its own. One table holds all automata: entry
    (state, column) is twice the next state's row, plus one if a new phrase begins there. A language
    has columns for its most frequent letters; transitions by its other letters are few, and stand
    in a list sorted by state and symbol.
    """

    def __init__(self, model: LanguageModel):
        self.languages = [lang for lang, _ in model.texts]
        lowered = [text.lower() for _, text in model.texts]
        counted = [Counter(c for c in text if c.isalpha()) for text in lowered]
        letters = sorted(set().union(*counted))
        kinds, self._kinds = len(lowered), len(letters) + 2
        # Letters are told from other characters for all code points; training letters get a symbol.
        self._symbol = np.zeros(0x110000, dtype=np.int32)
        self._letter = np.frombuffer(
            bytes(chr(c).isalpha() if not 0xD800 <= c < 0xE000 else 0 for c in range(0x110000)), dtype=np.uint8
        )
        self._symbol[self._letter == 0] = _GAP
        for n, letter in enumerate(letters):
            self._symbol[ord(letter)] = n + 2
        self.alphabet = min(model.symbols, max(map(len, counted), default=0)) + 2
        # By language and symbol: the table's column, and whether the list is asked instead.
        self._column = np.zeros((kinds, self._kinds), dtype=np.int32)
        self._column[:, _GAP] = _GAP
        self._listed = np.zeros((kinds, self._kinds), dtype=bool)
        self._first = np.zeros((kinds, self._kinds), dtype=np.int64)
        tables, roots, keys, targets, base = [], [], [], [], 0
        for k, (text, count) in enumerate(zip(lowered, counted)):
            for n, (letter, _) in enumerate(sorted(count.items(), key=lambda x: (-x[1], x[0]))):
                symbol = self._symbol[ord(letter)]
                if n < model.symbols:
                    self._column[k, symbol] = n + 2
                else:
                    self._listed[k, symbol] = True
            out = _transitions(self.symbols(text).tolist())
            step = np.full((len(out), self.alphabet), -1, dtype=np.int32)
            column, listed = self._column[k].tolist(), self._listed[k].tolist()
            for state, edges in enumerate(out):
                for symbol, target in edges.items():
                    if not listed[symbol]:
                        step[state, column[symbol]] = target
                        continue
                    keys.append((state + base) * self._kinds + symbol)
                    targets.append(target + base)
                    if state == 0:
                        self._first[k, symbol] = target + base
            step[:, _OTHER] = -1
            root = step[0]
            restart = np.where(root >= 0, root, 0)
            target = np.where(step < 0, restart, step).astype(np.int64)
            begun = step < 0
            begun[0] = True
            tables.append((((target + base) * self.alphabet) << 1) | begun)
            roots.append(base * self.alphabet)
            base += len(step)
        self._table = np.concatenate(tables).ravel().astype(np.int64 if base * self.alphabet >= 1 << 30 else np.int32)
        self._roots = np.array(roots, dtype=np.int64)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self._keys = np.array(keys, dtype=np.int64)[order]
        self._targets = np.array(targets, dtype=np.int64)[order]

    def symbols(self, text: str) -> np.ndarray:
        """Lowered letters as symbols; every run of other characters as one gap."""
        found = self._symbol[np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")]
        gap = found == _GAP
        return found[~(gap & np.concatenate([[True], gap[:-1]]))] if len(found) else found

    def _from_list(self, kinds: np.ndarray, rows: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Table entries for letters that have no column, by language, state's row and symbol."""
        key = rows.astype(np.int64) // self.alphabet * self._kinds + symbols
        place = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        known = self._keys[place] == key
        target = np.where(known, self._targets[place], self._first[kinds, symbols])
        return ((target * self.alphabet) << 1) | (~known | (rows == self._roots[kinds]))

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases by text and language; a text's phrases run on over the borders of its blocks."""
        counts = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        lanes, owners = [], []
        for n, text in enumerate(texts):
            for low in range(0, len(text), _BLOCK):
                lanes.append(text[low:low + _BLOCK])
                owners.append(n)
        owners, ends = np.array(owners, dtype=np.int64), None
        for low in range(0, len(lanes), _TOGETHER // _BLOCK):
            some = slice(low, low + _TOGETHER // _BLOCK)
            begun, ends = self._settled(
                lanes[some], owners[some], ends[-1] if low and owners[low] == owners[low - 1] else None
            )
            np.add.at(counts, owners[some], begun)
        return counts

    def _settled(
        self, lanes: list[np.ndarray], owners: np.ndarray, first: np.ndarray | None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Phrases begun in each block, and the states at its end, each block entered as left by the last.

        A text's blocks follow each other; ``first`` enters the first one, if its text began earlier.
        """
        entry = np.tile(self._roots, (len(lanes), 1))
        if first is not None:
            entry[0] = first
        follows = np.flatnonzero(owners[1:] == owners[:-1]) + 1
        counts, ends = self._parse(lanes, entry)
        for done in itertools.count():
            stale = follows[(entry[follows] != ends[follows - 1]).any(axis=1)]
            if not len(stale):
                return counts, ends
            if done >= _ROUNDS:
                stale = stale[np.unique(owners[stale], return_index=True)[1]]
            entry[stale] = ends[stale - 1]
            counts[stale], ends[stale] = self._parse([lanes[n] for n in stale], entry[stale])

    def _parse(self, lanes: list[np.ndarray], entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(lane) for lane in lanes])
        order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max())
        symbols = np.zeros((longest, len(lanes)), dtype=np.int32)
        for place, n in enumerate(order):
            symbols[: lengths[n], place] = lanes[n]
        # Lanes are sorted by length, so those that still run are a prefix.
        running = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
        kinds = len(self.languages)
        state = entry[order].T.astype(self._table.dtype)
        begun = np.zeros((kinds, len(lanes)), dtype=np.int32)
        for i in range(longest):
            n = running[i]
            symbol = symbols[i, :n]
            found = self._table[state[:, :n] + self._column[:, symbol]]
            if len(self._keys):
                kind, lane = np.nonzero(self._listed[:, symbol])
                if len(kind):
                    found[kind, lane] = self._from_list(kind, state[kind, lane], symbol[lane])
            begun[:, :n] += found & 1
            state[:, :n] = found >> 1
        counts, ends = (np.empty((len(lanes), kinds), dtype=np.int64) for _ in range(2))
        counts[order], ends[order] = begun.T, state.T
        return counts, ends

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        symbols = [self.symbols(text or "") for text in texts]
        lettered = np.array([bool((s != _GAP).any()) for s in symbols])
        per_letter = self.phrases(symbols) / np.maximum(1, [len(s) for s in symbols])[:, None]
        best = per_letter.argmin(axis=1)
        ranked = np.sort(per_letter, axis=1)
        runner = ranked[:, 1] if len(self.languages) > 1 else ranked[:, 0] * 2
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(runner > 0, 1 - ranked[:, 0] / runner, 0.0)
        return (
            [self.languages[b] if ok else "und" for b, ok in zip(best, lettered)],
            [float(s) if ok else 0.0 for s, ok in zip(score, lettered)],
        )


_parsers: dict[str, CrossParser] = {}


def _parser(model: LanguageModel) -> CrossParser:
    key = model.key
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = CrossParser(model)
    return _parsers[key]


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row: the language whose automaton needs fewest phrases.

    Whole texts are parsed. Phrases are normalised by the number of letters and gaps;
    of equal languages the first by name wins. The score is one minus the winner's share of the
    runner-up's phrases. NULL texts and those without a letter are ``und`` with score 0. Nothing
    but the text is looked at, no row is shuffled, and an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(model)
        for batch in batches:
            # Few long texts or many short ones at a time.
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            low = 0
            while low < len(ids):
                high, held = low, 0
                while high < len(ids) and (high == low or held + len(texts[high] or "") <= _TOGETHER):
                    held += len(texts[high] or "")
                    high += 1
                langs, scores = parser.predict(texts[low:high])
                yield batch_of(_OUT, {"doc_id": ids[low:high], "lang_pred": langs, "score": scores})
                low = high

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not model.texts:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(run, _OUT_SQL)
