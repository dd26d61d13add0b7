"""Byte-level BPE training over a distributed word table.

A word is kept as a string with one character per symbol, so a merge is Spark's own ``replace``
and a pair is a two-character string. Byte symbols are the characters of the public byte-level
alphabet, a merged token with id ``t`` is the character U+10000 + t. Both sort as their ids do,
so ordering pairs as strings breaks ties as (left id, right id) would.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let, nfkc, pretokens
from ..workspace import Rewritten, stage, staging

# Special tokens in id order, and the roles of some of them.
SPECIAL_TOKENS = ("<unk>", "<s>", "</s>", "<|im_start|>", "<|im_end|>")
UNK_ID, BOS_ID, EOS_ID = 0, 1, 2
PAD_ID = EOS_ID

# Merges tried in a round, at least and at most, and pairs whose counts the driver follows.
ROUND_MERGES = (4, 64)
FOLLOWED_PAIRS = 200_000
# The words and their index are written anew after so many merges, or when the rounds since have read
# so many times the index. Without an index words are written anew after fewer merges.
STAGE_AFTER = 256
REREAD = 2
SCANNED_MERGES = 64
# The index is written when rounds have read so many times the words without finding a pair in them.
# It holds a word once for each of its pairs and is shuffled, so it costs as much as many rounds.
IDLE_SCANS = 32
# Rows of the index in a folder, about, and folders at most.
FOLDER_ROWS = 100_000
FOLDERS = 2_048

_FIRST_MERGED = 0x10000


def byte_alphabet() -> dict[int, str]:
    """The public byte-level rule: printable Latin-1 stays, the rest moves to U+0100 upwards."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(moved)}


_ALPHABET = byte_alphabet()
_MOVED = [b for b, c in _ALPHABET.items() if ord(c) >= 0x100]


def byte_symbols(word: Column) -> Column:
    """The UTF-8 bytes of a word, one byte-level character each."""
    latin = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
    return F.translate(latin, "".join(map(chr, _MOVED)), "".join(_ALPHABET[b] for b in _MOVED))


def symbol_bytes(symbols: Column) -> Column:
    """Inverse of ``byte_symbols``, as binary. ``translate`` cannot give NUL, so it goes last."""
    others = [b for b in _MOVED if b != 0]
    latin = F.translate(symbols, "".join(_ALPHABET[b] for b in others), "".join(map(chr, others)))
    return F.encode(F.replace(latin, F.lit(_ALPHABET[0]), F.lit("\0")), "ISO-8859-1")


def pretoken_freq(df: DataFrame, text: str = "text") -> DataFrame:
    """``word, freq`` over the corpus."""
    normal = df.select(nfkc(F.col(text)).alias("_n"))
    # The outer form: for the inner one Spark adds a filter that splits every text once more.
    words = normal.select(F.explode_outer(pretokens(F.col("_n"))).alias("word")).where("word IS NOT NULL")
    return words.groupBy("word").agg(F.count("*").alias("freq"))


def symbol_words(words: DataFrame) -> DataFrame:
    """``sym, freq``: the words as byte symbols."""
    return words.select(byte_symbols(F.col("word")).alias("sym"), "freq")


def alphabet(words: DataFrame) -> DataFrame:
    """Byte symbols seen in ``sym``, at most 256."""
    chars = F.explode(F.array_distinct(F.split("sym", ""))).alias("token")
    return words.select(chars).where("token != ''").distinct()


def pairs_of(sym: Column) -> Column:
    """Overlapping pairs of neighbours; no match begins in the middle of a surrogate pair."""
    return F.regexp_extract_all(sym, F.lit(r"(?s)(?=([^\x{DC00}-\x{DFFF}].))"), F.lit(1))


def pair_count(words: DataFrame) -> DataFrame:
    """``pair, n``: neighbouring symbols weighted by word frequency."""
    pairs = words.select(F.explode_outer(pairs_of(F.col("sym"))).alias("pair"), "freq").where("pair IS NOT NULL")
    return pairs.groupBy("pair").agg(F.sum("freq").alias("n"))


@dataclass
class Round:
    """A job of training: how many merges it applied, and how many rows of the index or word table it read for them."""

    merges: int
    rows: int
    whole: bool = False  # all words were written anew and their pairs counted


@dataclass
class Vocabulary:
    """Tokens by id and merges in rank order; a result of bounded size."""

    tokens: list[str] = field(default_factory=lambda: list(SPECIAL_TOKENS))
    merges: list[tuple[int, int, int]] = field(default_factory=list)
    rounds: list[Round] = field(default_factory=list, compare=False)

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.tokens)), "id int, token string")

    def merges_table(self, spark: SparkSession) -> DataFrame:
        rows = [(rank, *merge) for rank, merge in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left int, right int, new_id int")

    def tokenizer_json(self) -> str:
        """The vocabulary in the public tokenizer file format."""
        def special(i: int, token: str) -> dict:
            return {"id": i, "content": token, "single_word": False, "lstrip": False,
                    "rstrip": False, "normalized": False, "special": True}

        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        model = {
            "type": "BPE", "dropout": None, "unk_token": SPECIAL_TOKENS[UNK_ID],
            "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False,
            "byte_fallback": False, "vocab": {t: i for i, t in enumerate(self.tokens)},
            "merges": [f"{self.tokens[a]} {self.tokens[b]}" for a, b, _ in self.merges],
        }
        return json.dumps({
            "version": "1.0", "truncation": None, "padding": None,
            "added_tokens": [special(i, t) for i, t in enumerate(SPECIAL_TOKENS)],
            "normalizer": {"type": "NFKC"}, "pre_tokenizer": byte_level, "post_processor": None,
            "decoder": byte_level, "model": model,
        }, ensure_ascii=False)


class _Symbols:
    """The character of each token and back, while training."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.id_of_token = {t: i for i, t in enumerate(vocab.tokens)}

    def id_of(self, char: str) -> int:
        return ord(char) - _FIRST_MERGED if ord(char) >= _FIRST_MERGED else self.id_of_token[char]

    def char_of(self, token_id: int) -> str:
        token = self.vocab.tokens[token_id]
        return token if len(token) == 1 else chr(_FIRST_MERGED + token_id)

    @staticmethod
    def char_of_new(token_id: int) -> str:
        return chr(_FIRST_MERGED + token_id)

    def joined(self, pair: str) -> str:
        return "".join(self.vocab.tokens[self.id_of(c)] for c in pair)

    def add(self, pair: str) -> tuple[str, str]:
        """Record a merge; gives the replacement to make in the words."""
        token = self.joined(pair)
        if token not in self.id_of_token:
            self.id_of_token[token] = len(self.vocab.tokens)
            self.vocab.tokens.append(token)
        new_id = self.id_of_token[token]
        self.vocab.merges.append((self.id_of(pair[0]), self.id_of(pair[1]), new_id))
        return pair, self.char_of(new_id)


def guessed(ranked: list[tuple[str, int]], symbols: _Symbols) -> list[str]:
    """The best pairs, up to one whose token exists already: it raises counts of pairs that are there, so it goes alone."""
    out, made = [], set()
    for pair, _ in ranked:
        token = symbols.joined(pair)
        if token in symbols.id_of_token or token in made:
            break
        out.append(pair)
        made.add(token)
    return out or [ranked[0][0]]


# A batch of words is one text with a line per word, so a merge is one ``replace`` for all of them.


def _applied(text: str, merges: list[tuple[str, str]]) -> str:
    for pair, char in merges:
        text = text.replace(pair, char)
    return text


def _places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring symbols within words as numbers, and the word each is in."""
    code = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    ends = code == ord("\n")
    inner = ~(ends[:-1] | ends[1:])
    return (code[:-1] << 32 | code[1:])[inner], np.cumsum(ends)[:-1][inner]


def _pair_strings(keys: np.ndarray) -> list[str]:
    text = np.stack([keys >> 32, keys & 0xFFFFFFFF], 1).astype("<u4").tobytes().decode("utf-32-le")
    return [text[i : i + 2] for i in range(0, len(text), 2)]


class _Sums:
    """Sums by step and pair, held as arrays: what a task hands on does not grow with its words."""

    def __init__(self):
        self.keys, self.n, self.held = [], [], 0

    def add(self, step: int, first: np.ndarray, second: np.ndarray, n: np.ndarray) -> None:
        self.keys.append(step << 42 | first.astype(np.int64) << 21 | second)
        self.n.append(n)
        self.held += len(n)
        if self.held > 1 << 21:
            self._reduce()

    def _reduce(self) -> None:
        keys, n = np.concatenate([np.zeros(0, np.int64), *self.keys]), np.concatenate([np.zeros(0, np.int64), *self.n])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        n = np.add.reduceat(n, first) if len(first) else n
        self.keys, self.n, self.held = [keys[first][n != 0]], [n[n != 0]], 0

    def batch(self) -> pa.RecordBatch:
        self._reduce()
        keys, low = self.keys[0], (1 << 21) - 1
        pairs = _pair_strings((keys >> 21 & low) << 32 | keys & low)
        return pa.RecordBatch.from_arrays(
            [pa.array((keys >> 42).astype(np.int32)), pa.array(pairs, pa.string()), pa.array(self.n[0], pa.int64())], ["step", "pair", "n"])


def _summed(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("pair").agg(F.sum("n").alias("n")).where("n != 0")


def _counted(words: DataFrame) -> DataFrame:
    """``pair_count`` of symbol words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for batch in batches:
            keys, word = _places("\n".join(batch.column("sym").to_pylist()))
            sums.add(0, keys >> 32, keys & 0xFFFFFFFF, batch.column("freq").to_numpy()[word])
        yield sums.batch()

    return _summed(words.mapInArrow(run, "step int, pair string, n long"))


def _rewritten(words: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """The words after ``merges``; those that are one symbol go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _applied("\n".join(batch.column("sym").to_pylist()), merges).split("\n")
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), batch.column("freq")], ["sym", "freq"])

    return words.mapInArrow(run, "sym string, freq long").where(F.char_length("sym") > 1)


def _folder(pair: str, folders: int) -> int:
    return zlib.crc32(pair.encode()) % folders


def _holders(words: DataFrame, folders: int) -> DataFrame:
    """A row for each word and distinct pair in it: folder, pair, sym, freq."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, word = _places("\n".join(batch.column("sym").to_pylist()))
            own, pair = np.unique(keys, return_inverse=True)
            both = np.unique(word * max(1, len(own)) + pair)
            word, pair = both // max(1, len(own)), both % max(1, len(own))
            names = _pair_strings(own)
            folder = np.array([_folder(p, folders) for p in names], np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(folder[pair], pa.int32()), pa.array(names, pa.string()).take(pa.array(pair)), batch.column("sym").take(pa.array(word)),
                 batch.column("freq").take(pa.array(word))], ["folder", "pair", "sym", "freq"])

    return words.mapInArrow(run, "folder int, pair string, sym string, freq long")


def _merged(text: str, freq: np.ndarray, merges: list[tuple[str, str]], sums: _Sums) -> int:
    """Make ``merges`` one after the other in the words of ``text``, adding what each changes in the pair counts to ``sums``.

    A merge changes only the pairs at its places and beside them. Gives the number of words with any of the merges.
    """
    code = np.frombuffer(f"\n{text}\n".encode("utf-32-le"), "<u4").astype(np.int32)
    word = (np.cumsum(code == 10) - 1).astype(np.int32)
    hit = np.zeros(len(freq) + 2, bool)

    def add(step: int, at: np.ndarray, sign: int) -> None:
        first, second = code[at], code[at + 1]
        inner = (first != 10) & (second != 10)
        sums.add(step, first[inner], second[inner], sign * freq[word[at[inner]]])

    for step, (pair, char) in enumerate(merges):
        a, b = map(ord, pair)
        at = np.flatnonzero(code[:-1] == a)
        at = at[code[at + 1] == b]
        if a == b and len(at):  # in a run of one symbol every second place, from the left
            first = np.flatnonzero(np.diff(at, prepend=-1) != 1)
            first = np.append(first, len(at))
            at = at[(np.arange(len(at)) - np.repeat(first[:-1], np.diff(first))) % 2 == 0]
        if not len(at):
            continue
        hit[word[at]] = True
        add(step, np.unique(np.concatenate([at - 1, at, at + 1])), -1)
        code[at] = ord(char)
        code, word = np.delete(code, at + 1), np.delete(word, at + 1)
        at = at - np.arange(len(at))
        add(step, np.unique(np.concatenate([at - 1, at])), 1)
    return int(hit.sum())


def _changes(found: DataFrame, keys: list[str] | None, since: list[tuple[str, str]], merges: list[tuple[str, str]]) -> DataFrame:
    """Differences of pair counts that each of ``merges`` makes, one after the other, in words that are behind by ``since``.

    A word that several keys find counts under the first of them; without keys every row is a word of its own. The row with step
    -1 says how many words hold any of the merges.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held = _Sums(), 0
        for batch in batches:
            words, freq = batch.column("sym").to_pylist(), batch.column("freq").to_numpy()
            if keys is not None:
                pair = batch.column("pair").to_pylist()
                own = [i for i, (s, p) in enumerate(zip(words, pair)) if next(k for k in keys if k in s) == p]
                words, freq = [words[i] for i in own], freq[own]
            held += _merged(_applied("\n".join(words), since), freq, merges, sums)
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([""]), pa.array([held], pa.int64())], ["step", "pair", "n"])
        yield sums.batch()

    return found.mapInArrow(run, "step int, pair string, n long").groupBy("step", "pair").agg(F.sum("n").alias("n")).where("n != 0")


class PairCounts:
    """Counts of the most frequent pairs; any pair not among them occurs at most ``floor`` times.

    Counts fall as symbols are merged away; a pair that a merge creates is new, and all its
    occurrences are in the difference that is added. So ``floor`` holds until the pairs are counted anew.
    """

    def __init__(self, ranked: list[tuple[str, int]], floor: int):
        self.floor, self.n = floor, dict(ranked)
        self.waiting = [(-n, pair) for pair, n in ranked]  # a heap: the rows come in this order

    def add(self, pair: str, n: int) -> None:
        n += self.n.pop(pair, 0)
        if n > self.floor:
            self.n[pair] = n
            heapq.heappush(self.waiting, (-n, pair))

    def best(self, k: int) -> list[tuple[str, int]]:
        """The k most frequent pairs, ties by pair. Outdated entries of the heap go on the way."""
        out: dict[str, int] = {}
        while self.waiting and len(out) < k:
            n, pair = heapq.heappop(self.waiting)
            if self.n.get(pair) == -n:
                out[pair] = -n
        for pair, n in out.items():
            heapq.heappush(self.waiting, (-n, pair))
        return list(out.items())


class WordIndex:
    """The words, and, once it pays, for each pair the words that hold it, in folders by a hash of the pair.

    The first merges are in most words, so a round reads all of them. When few words hold what a round tries, the
    index is written. Words stand then as they were when it was written. A word that holds a pair now held then all
    pairs inside it, so the rarest of these finds it, and the merges since bring it up to date. The
    index is not touched by merges; it is written anew when many have gathered.
    """

    def __init__(self, words: DataFrame, min_frequency: int):
        self.min_frequency = min_frequency
        self.tasks = words.sparkSession.sparkContext.defaultParallelism
        self.words = Rewritten(words.where(F.char_length("sym") > 1).repartition(self.tasks), "words")
        self.since: list[tuple[str, str]] = []
        self.table: Rewritten | None = None
        self.idle = 0  # words read without a pair that was tried
        self._write()

    def _write(self) -> None:
        words = self.words.df
        self.words_read = rows = words.count()
        if self.table is not None or self.idle > IDLE_SCANS * rows:
            self._write_index(words, rows)
        self.read = 0
        counted = _counted(words).where(F.col("n") >= self.min_frequency).orderBy(F.desc("n"), "pair").limit(FOLLOWED_PAIRS)
        ranked = [(r.pair, r.n) for r in counted.collect()]
        complete = len(ranked) < FOLLOWED_PAIRS
        self.counts = PairCounts(ranked, self.min_frequency - 1 if complete else ranked[-1][1])
        self.complete, self.fresh = complete, True
        self.at_writing = dict(ranked)
        self.inside: dict[str, str] = {}  # symbols made since then as the symbols of then

    def _write_index(self, words: DataFrame, rows: int) -> None:
        self.folders = max(1, min(FOLDERS, rows * 8 // FOLDER_ROWS))
        held = _holders(words, self.folders)
        # By range with a hash of the word last: a frequent pair is many ranges.
        order = ["folder", "pair", F.xxhash64("sym")]
        ranges = max(self.tasks * 16, rows * 8 // FOLDER_ROWS)
        held = held.repartitionByRange(ranges, *order).sortWithinPartitions("folder", "pair")
        if self.table is None:
            self.table = Rewritten(held, "pair_index", ("folder",))
        else:
            self.table.replace(held)
        self.rows = self.table.df.count()

    def renew(self) -> None:
        """Bring the written words up to date, index them if that pays and count their pairs."""
        self.words.replace(_rewritten(self.words.df, self.since))
        self.since = []
        self._write()

    def due(self) -> bool:
        if self.table is None:
            return len(self.since) >= SCANNED_MERGES or bool(self.since) and self.idle > IDLE_SCANS * self.words_read
        return len(self.since) >= STAGE_AFTER or self.read > REREAD * self.rows

    def _key(self, pair: str) -> str:
        """The rarest pair, when the index was written, that every word with ``pair`` held then."""
        then = "".join(self.inside.get(c, c) for c in pair)
        inner = [then[i : i + 2] for i in range(len(then) - 1)]
        return min(inner, key=lambda p: (self.at_writing.get(p, self.counts.floor), p))

    def changes(self, merges: list[tuple[str, str]]) -> tuple[list[list[tuple[str, int]]], int]:
        """By merge, what it changes in the pair counts after those before it; and the rows read.

        A merge changes only pairs with one of its three symbols, so the differences are bounded by
        the vocabulary, not by the words.
        """
        steps: list[list[tuple[str, int]]] = [[] for _ in merges]
        if self.table is None:
            rows, held = self.words_read, 0
            for r in _changes(self.words.df, None, list(self.since), merges).collect():
                if r.step < 0:
                    held = r.n
                else:
                    steps[r.step].append((r.pair, r.n))
            self.idle += rows - held
            return steps, rows
        keys = sorted({self._key(pair) for pair, _ in merges})
        folders = sorted({_folder(k, self.folders) for k in keys})
        found = self.table.df.where(F.col("folder").isin(folders) & F.col("pair").isin(keys))
        seen = Observation()
        found = found.observe(seen, F.count(F.lit(1)).alias("rows"))
        for r in _changes(found, keys, list(self.since), merges).where("step >= 0").collect():
            steps[r.step].append((r.pair, r.n))
        self.read += seen.get["rows"]
        return steps, seen.get["rows"]

    def apply(self, merge: tuple[str, str], changes: list[tuple[str, int]]) -> None:
        for pair, n in changes:
            self.counts.add(pair, n)
        pair, char = merge
        self.inside[char] = "".join(self.inside.get(c, c) for c in pair)
        self.since.append(merge)
        self.fresh = False


def train_bpe(words: DataFrame, vocab_size: int = 12_000, min_frequency: int = 2) -> Vocabulary:
    """Train on ``word, freq``.

    A round guesses that the best pairs are merged in their order, reads the words that hold one of them and learns
    what each merge changes. Merges count as long as each is the best pair after those before it; the rest of the guess is
    dropped. Only the counts of the most frequent pairs, their changes and the vocabulary reach the
    driver; ``rounds`` says what was read.
    """
    with staging(words.sparkSession):
        return _trained(stage(symbol_words(words), "symbols"), vocab_size, min_frequency)


def _trained(words: DataFrame, vocab_size: int, min_frequency: int) -> Vocabulary:
    vocab = Vocabulary()
    vocab.tokens += sorted(r.token for r in alphabet(words).collect())
    symbols = _Symbols(vocab)
    index = WordIndex(words, min_frequency)
    vocab.rounds.append(Round(0, index.words_read, True))
    tried = ROUND_MERGES[0]

    def renew() -> None:
        merges = len(index.since)
        index.renew()
        vocab.rounds.append(Round(merges, index.words_read, True))

    while len(vocab.tokens) < vocab_size:
        ranked = index.counts.best(tried)
        # Pairs that are not followed may be as frequent as the floor; right after counting, ties are in order.
        known = ranked and (ranked[0][1] > index.counts.floor or index.fresh)
        if not known and index.complete:
            break
        if not known or index.due():
            renew()
            continue
        guess = guessed(ranked, symbols)
        if symbols.joined(guess[0]) in symbols.id_of_token:
            index.since.append(symbols.add(guess[0]))
            renew()
            continue
        if len(vocab.tokens) + 1 == vocab_size:
            symbols.add(guess[0])  # nobody asks what the last merge changes
            break
        first = len(vocab.tokens)
        steps, rows = index.changes([(pair, symbols.char_of_new(first + i)) for i, pair in enumerate(guess)])
        done = 0
        for pair, changes in zip(guess, steps):
            best = index.counts.best(1)
            if len(vocab.tokens) >= vocab_size or done and (not best or best[0][0] != pair or best[0][1] <= index.counts.floor):
                break
            index.apply(symbols.add(pair), changes)
            done += 1
        vocab.rounds.append(Round(done, rows))
        tried = min(max(2 * done, ROUND_MERGES[0]), ROUND_MERGES[1])
    return vocab


def save_vocabulary(spark: SparkSession, vocab: Vocabulary, path: str) -> None:
    """``vocab`` and ``merges`` as Parquet and the public tokenizer file as text."""
    vocab.vocab_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")
    vocab.merges_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")
    spark.createDataFrame([(vocab.tokenizer_json(),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path}/tokenizer_json")


def load_vocabulary(spark: SparkSession, path: str) -> Vocabulary:
    tokens = spark.read.parquet(f"{path}/vocab").orderBy("id").collect()
    merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
    return Vocabulary([r.token for r in tokens], [(r.left, r.right, r.new_id) for r in merges])
