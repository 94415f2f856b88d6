"""BPE encoding and decoding by batched numpy merge rounds.

The symbols of many words lie in one flat array.  In each round the rank of
every adjacent pair is found by binary search over the sorted pair keys, each
word merges all places of its lowest-ranked pair (leftmost first where they
overlap), and the arrays are compacted; words without a mergeable pair leave.
Words of over LONG bytes would take as many rounds as they have ranks: they are
merged rank by rank, a round touching only the rank's own places and their neighbours.

Normalising and splitting follow the vocabulary file, whose kind is BPE with
byte symbols, word ends, lower-casing and dropped white space.  Its added
tokens are found in the raw text.  Decoding joins the tokens with one space.

Distinct words of a slice of a batch are encoded once, and a slice holds
a million characters unless one text is longer; nothing outlives a slice.
The vocabulary (a fixed file, under 2 MB) is read on the driver and broadcast.

Defined cases: a null text counts as empty, an empty text has no ids and
decodes to an empty text; repeated rows are encoded one by one; a null id is
carried through; an empty table gives no rows; extra columns are never read.
What a letter or digit is follows the ``regex`` module, whose Unicode tables
are newer than the tokenizers library's: characters assigned to Unicode only
in its last versions may split differently.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from pitlake.llm.texts import over_texts

LONG = 500
FAR = np.iinfo(np.int64).max


@dataclass
class Vocabulary:
    tokens: dict          # token -> id, added tokens too
    first: np.ndarray     # id of each byte's symbol inside a word
    last: np.ndarray      # id of each byte's symbol at a word's end
    keys: np.ndarray      # sorted pair keys, left * size + right
    ranks: np.ndarray     # rank of each pair
    made: np.ndarray      # id that each pair becomes
    size: int
    split: str            # pattern of the words
    added: list           # added tokens, to be found in raw text


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is
    printable Latin-1, else the next free character from 256 on."""
    out, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    vocab, end = dict(model["vocab"]), model["end_of_word_suffix"]
    vocab |= {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max(vocab.values()) + 1
    symbols = byte_symbols()
    pairs = {}
    for rank, (a, b) in enumerate(model["merges"]):
        pairs.setdefault(vocab[a] * size + vocab[b], (rank, vocab[a + b]))
    keys = np.array(sorted(pairs), np.int64)
    return Vocabulary(vocab, np.array([vocab[s] for s in symbols], np.int64), np.array([vocab[s + end] for s in symbols], np.int64),
                      keys, np.array([pairs[k][0] for k in keys.tolist()], np.int64), np.array([pairs[k][1] for k in keys.tolist()], np.int64),
                      size, spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"], [t["content"] for t in spec["added_tokens"]])


def merge_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and the number of ids of each word."""
    n = np.array([len(w) for w in words], np.int64)
    raw = np.frombuffer(b"".join(words), np.uint8)
    symbols = v.first[raw]
    if len(raw):
        ends = np.cumsum(n) - 1
        symbols[ends] = v.last[raw[ends]]
    word = np.repeat(np.arange(len(words)), n)
    done_s, done_w = [], []
    long = np.repeat(n > LONG, n)
    if long.any():
        for out, part in zip((done_s, done_w), merge_long(symbols[long], word[long], v)):
            out.append(part)
        symbols, word = symbols[~long], word[~long]
    while len(symbols):
        # the rank of the pair that starts at each place
        key = symbols[:-1] * v.size + symbols[1:]
        at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
        known = (v.keys[at] == key) & (word[:-1] == word[1:])
        rank = np.append(np.where(known, v.ranks[at], FAR), FAR)
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        lowest = np.minimum.reduceat(rank, starts)
        lengths = np.diff(np.append(starts, len(symbols)))
        active = np.repeat(lowest < FAR, lengths)
        chosen = active & (rank == np.repeat(lowest, lengths))
        done_s.append(symbols[~active])
        done_w.append(word[~active])
        # of places that overlap, every second one from the left
        places = np.flatnonzero(chosen)
        places = places[evens(np.r_[True, np.diff(places) > 1])] if len(places) else places
        symbols = symbols.copy()
        symbols[places] = v.made[at[places]]
        left = active.copy()
        left[places + 1] = False
        symbols, word = symbols[left], word[left]
    ids, owner = np.concatenate([*done_s, symbols]), np.concatenate([*done_w, word])
    order = np.argsort(owner, kind="stable")
    return ids[order], np.bincount(owner, minlength=len(words))


def evens(run_starts: np.ndarray) -> np.ndarray:
    """Which places of each run are its first, third, fifth and so on."""
    index = np.arange(len(run_starts))
    return (index - np.maximum.accumulate(np.where(run_starts, index, 0))) % 2 == 0


def merge_long(symbols: np.ndarray, word: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Symbols after all merges, and the word of each; work in proportion to the merges made."""
    n = len(symbols)
    symbols = symbols.copy()
    before, after = np.arange(-1, n - 1), np.arange(1, n + 1)       # neighbours that are still there
    rank, made, there = np.full(n, FAR), np.zeros(n, np.int64), np.ones(n, bool)
    places_of: dict[int, list[np.ndarray]] = {}
    ranks: list[int] = []

    def look(places: np.ndarray) -> None:
        """Ranks of the pairs that start at ``places``; those known wait under their rank."""
        rank[places] = FAR
        places = places[after[places] < n]
        places = places[word[places] == word[after[places]]]
        key = symbols[places] * v.size + symbols[after[places]]
        at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
        known = v.keys[at] == key
        places, at = places[known], at[known]
        rank[places], made[places] = v.ranks[at], v.made[at]
        order = np.argsort(rank[places], kind="stable")
        places = places[order]
        starts = np.flatnonzero(np.r_[True, np.diff(rank[places]) > 0]) if len(places) else []
        for group in np.split(places, starts[1:]) if len(places) else ():
            r = int(rank[group[0]])
            if r not in places_of:
                places_of[r] = []
                heapq.heappush(ranks, r)
            places_of[r].append(group)

    look(np.arange(n))
    while ranks:
        r = heapq.heappop(ranks)
        places = np.unique(np.concatenate(places_of.pop(r)))
        places = places[rank[places] == r]          # some have been merged or have another neighbour by now
        if not len(places):
            continue
        places = places[evens(np.r_[True, places[1:] != after[places[:-1]]])]
        gone = after[places]
        symbols[places] = made[places]
        there[gone], rank[gone] = False, FAR
        after[places] = after[gone]
        inside = after[places] < n
        before[after[places[inside]]] = places[inside]
        near = before[places]
        look(np.unique(np.concatenate([near[near >= 0], places])))
    return symbols[there], word[there]


def lower(s: str) -> str:
    """Lower case character by character (no final sigma)."""
    return s.replace("Σ", "σ").lower()


class Coder:
    def __init__(self, v: Vocabulary):
        self.v = v
        self.words = regex.compile(v.split)
        self.space = regex.compile(r"\s+")
        self.specials = regex.compile("|".join(map(regex.escape, sorted(v.added, key=len, reverse=True)))) if v.added else None
        self.names = {i: t for t, i in v.tokens.items()}

    def pieces(self, text: str) -> list[bytes | int]:
        """Words as bytes, and ids of added tokens, in order."""
        out: list[bytes | int] = []
        at = 0
        for m in [*(self.specials.finditer(text) if self.specials else ()), None]:
            part = text[at:m.start()] if m else text[at:]
            clean = lower(self.space.sub(" ", unicodedata.normalize("NFC", part)))
            out += [w.encode() for w in self.words.findall(clean)]
            if m:
                out.append(self.v.tokens[m[0]])
                at = m.end()
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        index: dict = {}
        docs = [np.fromiter((index.setdefault(p, len(index)) for p in self.pieces(t)), np.int64) for t in texts]
        if not index:
            return [np.zeros(0, np.int64) for _ in texts]
        words = [p for p in index if isinstance(p, bytes)]
        ids, n = merge_words(words, self.v)
        # one table over all pieces: added tokens are one id each
        place = np.array([index[p] for p in words], np.int64)
        count = np.ones(len(index), np.int64)
        count[place] = n
        start = np.cumsum(count) - count
        table = np.zeros(count.sum(), np.int64)
        inside = np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n)
        table[np.repeat(start[place], n) + inside] = ids
        for p, i in index.items():
            if not isinstance(p, bytes):
                table[start[i]] = p
        out = []
        for d in docs:
            c = count[d]
            out.append(table[np.repeat(start[d], c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)])
        return out

    def decode(self, ids) -> str:
        return " ".join(self.names[i] for i in ids.tolist() if i in self.names)


#: columns that ``coded`` can make
MADE = {"n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def coded(docs: DataFrame, vocabulary_path: str, columns: tuple[str, ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its id and the chosen columns of MADE."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(read_vocabulary(vocabulary_path)))

    def make():
        coder = Coder(Vocabulary(**shared.value))

        def run(texts):
            ids = coder.encode(texts)
            decoded = [coder.decode(i) for i in ids] if {"decoded", "decoded_sha256"} & set(columns) else []
            found = {"n_tokens": lambda: [len(i) for i in ids], "ids": lambda: [i.astype(np.int32) for i in ids], "decoded": lambda: decoded,
                     "ids_sha256": lambda: [hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids],
                     "decoded_sha256": lambda: [hashlib.sha256(d.encode()).hexdigest() for d in decoded]}
            return {c: found[c]() for c in columns}

        return run

    return over_texts(docs, id_col, text_col, make, {c: MADE[c] for c in columns})


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def bpe_query(spark: SparkSession, docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    return coded(docs, vocabulary_path or default_vocabulary(), ("n_tokens", "ids_sha256", "decoded_sha256"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded text.

    A null or empty text has an empty array of ids; repeated rows and null ids
    are encoded row by row; texts of any length are encoded whole; no rows give
    no rows.
    """
    return coded(docs, default_vocabulary(), ("n_tokens", "ids", "ids_sha256", "decoded_sha256"))
