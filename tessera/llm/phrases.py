"""Phrase collocations: candidates level by level, counted by broadcast double-array tries.

A candidate of k words is a window of the texts whose first and last k - 1 words are candidates
themselves (Apriori); windows that the sums of all tasks leave below the wanted frequency are
screened out. The candidates of a level become double-array tries of bounded size over 64-bit
word hashes, which are broadcast. A task moves the states of all positions of its texts one word
further at a time; positions that end in an accepting state are counted by bincount, and the
tasks' counts are summed. The same walk yields the windows for the next level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import PrefixHasher, byte_numbers, checkpointed

#: Phrases of one trie, and bytes of text that are walked at once.
BLOCK_PHRASES, CHUNK_BYTES = 1 << 18, 1 << 21
#: Characters between pieces, and between words.
PIECE_ENDS, WORD_ENDS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
_ENDS = np.isin(np.arange(256), list(PIECE_ENDS))
_IN_WORD = ~np.isin(np.arange(256), list(PIECE_ENDS + WORD_ENDS))
#: Hash value that no word has: the end of a piece.
_END = np.uint64(1)
_LOW = (1 << 28) - 1
_SCHEMA = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


def _letters(salt: int) -> np.ndarray:
    """Numbers of the bytes, the same for A-Z as for a-z, and the base."""
    table = byte_numbers(salt)
    table[ord("A"):ord("Z") + 1] = table[ord("a"):ord("z") + 1]
    return table


def _hasher(salt: int) -> PrefixHasher:
    return PrefixHasher(_letters(salt))


@dataclass
class _Chunk:
    """Words of whole pieces of some texts: bytes, place, language (a number into ``langs``) and piece."""

    data: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    langs: list
    number: np.ndarray
    piece: np.ndarray

    def word(self, i: int) -> str:
        return self.data[self.starts[i]:self.stops[i]].tobytes().lower().decode("utf-8")

    def positions(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash and language by position, with an _END after each piece; and each position's word."""
        last = np.concatenate([self.piece[1:] != self.piece[:-1], [True]]) if len(hashes) else np.empty(0, bool)
        at = np.arange(len(hashes)) + np.cumsum(last) - last
        size = len(hashes) + int(last.sum())
        value, number, word = np.full(size, _END), np.zeros(size, np.int64), np.full(size, -1)
        value[at], number[at], word[at] = hashes, self.number, np.arange(len(hashes))
        return value, number, word


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunk]:
    """Chunks of about CHUNK_BYTES, cut between texts or pieces; a longer piece is a chunk of its own."""
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        if not len(texts) or offsets[-1] == offsets[0]:
            continue
        data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        lang, of_row = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
        at = 0
        while at < len(data):
            to = min(at + CHUNK_BYTES, len(data))
            while to < len(data):
                row = int(np.searchsorted(offsets, to, "right")) - 1
                ends = np.flatnonzero(_ENDS[data[at:to]])
                cut = max(int(offsets[row]) if offsets[row] > at else 0, at + int(ends[-1]) + 1 if len(ends) else 0)
                if cut:
                    to = cut
                    break
                to = min(to + CHUNK_BYTES, len(data))
            yield _chunk(data[at:to], offsets, at, list(lang), of_row)
            at = to


def _chunk(data: np.ndarray, offsets: np.ndarray, at: int, langs: list, of_row: np.ndarray) -> _Chunk:
    heads = np.unique(offsets[(offsets > at) & (offsets < at + len(data))] - at)  # where a text begins
    inside = _IN_WORD[data]
    before = np.concatenate([[False], inside[:-1]])
    before[heads] = False
    after = np.concatenate([inside[1:], [False]])
    after[heads - 1] = False
    starts, stops = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(offsets, starts + at, "right") - 1
    return _Chunk(data, starts, stops, langs, of_row[row], np.cumsum(_ENDS[data])[starts] + row)


def _count_words(salt: int):
    """Task: occurrences of each word of a language in a chunk by hash, with the range of a second hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _hasher(salt), _hasher(salt + 1000)
        for c in _chunks(batches):
            h, other = first(c.data, c.starts, c.stops), second(c.data, c.starts, c.stops).view(np.int64)
            order = np.lexsort((h, c.number))
            h, other, number = h[order], other[order], c.number[order]
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (number[1:] != number[:-1])])[:len(h)])
            if len(new):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c.langs[k] for k in number[new]], pa.string()), pa.array(h[new].view(np.int64)),
                     pa.array(np.minimum.reduceat(other, new)), pa.array(np.maximum.reduceat(other, new)),
                     pa.array(np.diff([*new, len(h)]))], ["lang", "h", "low", "high", "n"])
    return run


def _block(hashes: list[np.ndarray], blocks: int) -> np.ndarray:
    """Block of a phrase, from its words' hashes."""
    return sum((2 * i + 1) * (h.astype(np.uint64) & np.uint64(_LOW)).astype(np.int64) for i, h in enumerate(hashes)) % blocks


def _block_of(words: Column, k: int, blocks: int) -> Column:
    """The same of a column of hash arrays."""
    return sum(((2 * i + 1) * words[i].bitwiseAND(F.lit(_LOW)) for i in range(k)), F.lit(0)) % blocks


@dataclass
class Trie:
    """Double-array trie: the child of slot s by code c is base[s] + c if check of it is s."""

    words: np.ndarray  # sorted hashes; a word's code is its place
    roots: dict  # language -> slot
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray  # slot -> place of the phrase that ends there, -1
    depth: int

    @classmethod
    def build(cls, langs: list[str], words: np.ndarray) -> Trie:
        """Of equally long phrases: their languages and an array of hashes, a row each."""
        n, depth = words.shape
        vocabulary, codes = np.unique(words, return_inverse=True)
        codes = codes.reshape(n, depth).astype(np.int64)
        names = {x: i for i, x in enumerate(dict.fromkeys(langs))}
        symbols = np.column_stack([np.array([names[x] for x in langs], np.int64) + len(vocabulary), codes])
        alphabet = len(vocabulary) + len(names)
        slots = _Slots(alphabet, n * (depth + 1))
        slot = np.full(n, slots.root())
        for d in range(depth + 1):
            edge, of_phrase = np.unique(slot * alphabet + symbols[:, d], return_inverse=True)
            slot = slots.place(edge // alphabet, edge % alphabet)[of_phrase.ravel()]
        base, check = slots.arrays()
        accept = np.full(len(check), -1, np.int32)
        accept[slot] = np.arange(n)
        root = slots.root()
        return cls(vocabulary, {x: int(base[root] + len(vocabulary) + i) for x, i in names.items()}, base, check, accept, depth)

    def walk(self, langs: list[str], number: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions where a phrase begins, and which; the code of each position, -1 for none."""
        code = np.searchsorted(self.words, value)
        code[code == len(self.words)] = 0
        code = np.concatenate([np.where(self.words[code] == value, code, -1), np.full(self.depth, -1)])
        start = np.array([self.roots.get(x, -1) for x in langs], np.int64)[number]
        at = np.flatnonzero((code[:len(value)] >= 0) & (start >= 0))
        state = start[at]
        for d in range(self.depth):
            c = code[at + d]
            known = c >= 0
            at, state = at[known], state[known]
            to = self.base[state] + c[known]
            hit = self.check[to] == state
            at, state = at[hit], to[hit].astype(np.int64)
        return at, self.accept[state], code


class _Slots:
    """Places the children of the trie's nodes: of many children first, into gaps where they fit."""

    TRIES, AT_ONCE = 16, 64

    def __init__(self, alphabet: int, nodes: int):
        self.pad = alphabet  # before and after, so that no code leads outside
        self.size = 2 * nodes + 64
        self.base = np.zeros(self.size + 2 * self.pad, np.int64)
        self.check = np.full(self.size + 2 * self.pad, -1, np.int64)
        self.check[self.pad] = -2  # the root
        self.rng = np.random.default_rng(1)

    def root(self) -> int:
        return self.pad

    def place(self, parent: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Slots of the children; edges come sorted by parent, each parent once and for all."""
        first = np.flatnonzero(np.diff(parent, prepend=-1))
        many = np.diff([*first, len(parent)])
        single = first[many == 1]
        for i in first[np.argsort(-many, kind="stable")][:len(first) - len(single)]:
            n = int(many[np.searchsorted(first, i)])
            self._fit(int(parent[i]), code[i:i + n])
        free = np.flatnonzero(self.check[self.pad:self.pad + self.size] == -1)[:len(single)] + self.pad
        self.base[parent[single]] = free - code[single]
        self.check[free] = parent[single]
        return self.base[parent] + code

    def _fit(self, parent: int, codes: np.ndarray) -> None:
        for _ in range(self.TRIES):
            at = self.rng.integers(self.pad, self.pad + self.size - int(codes[-1] - codes[0]), self.AT_ONCE) if (
                self.size > codes[-1] - codes[0]) else np.empty(0, np.int64)
            fits = np.flatnonzero((self.check[at[:, None] + (codes - codes[0])] == -1).all(axis=1))
            if len(fits):
                start = int(at[fits[0]])
                break
        else:
            start, more = self.pad + self.size, int(codes[-1] - codes[0]) + 1
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
            self.size += more
        self.base[parent] = start - codes[0]
        self.check[start + codes - codes[0]] = parent

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return self.base.astype(np.int32), self.check.astype(np.int32)


def _count_phrases(shared, block: int, blocks: int, salt: int, extend: bool):
    """Task: occurrences of a trie's phrases, by id; and of the windows one word longer, by id and next word.

    Counts of single words name the word.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, trie = shared.value
        hashes, total, words = _hasher(salt), np.zeros(len(ids), np.int64), {}
        for c in _chunks(batches):
            value, number, word = c.positions(hashes(c.data, c.starts, c.stops))
            at, phrase, code = trie.walk(c.langs, number, value)
            if trie.depth == 1:
                found, first = np.unique(phrase, return_index=True)
                words |= {p: c.word(word[at[i]]) for p, i in zip(found.tolist(), first) if not total[p]}
            total += np.bincount(phrase, minlength=len(ids))
            if not extend:
                continue
            here = np.zeros(len(value) + 1, bool)
            here[at] = True
            safe = here[at + 1]
            if blocks > 1:  # another block's trie knows the window's last words
                inside = at + trie.depth < len(value)
                inside[inside] = value[at[inside] + trie.depth] != _END
                tail = [value[at[inside] + 1 + i] for i in range(trie.depth)]
                safe[inside] |= _block(tail, blocks) != block
            at, phrase = at[safe], phrase[safe]
            following, key = value[at + trie.depth], phrase.astype(np.int64) * (len(trie.words) + 1) + code[at + trie.depth] + 1
            # by number where the trie has the next word, by hash too where it has not
            order = np.argsort(key, kind="stable") if blocks == 1 else np.lexsort((following, key))
            key, following, phrase = key[order], following[order], phrase[order]
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (following[1:] != following[:-1])])[:len(key)])
            yield _rows(ids[phrase[new]], following[new].astype(np.int64), None, np.diff([*new, len(key)]))
        met = np.flatnonzero(total)
        yield _rows(ids[met], None, [words.get(p) for p in met.tolist()], total[met])
    return run


def _rows(ids, following, words, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.nulls(len(ids), pa.int64()) if following is None else pa.array(following),
         pa.array([None] * len(ids) if words is None else words, pa.string()), pa.array(np.asarray(n, np.int64))],
        ["id", "next", "word", "n"])


def _words(rows: DataFrame, least: int) -> tuple[DataFrame, DataFrame, int]:
    """Totals by language, frequent words by hash, and the salt under which no two words of a language share a hash."""
    for salt in range(8):
        counted = (rows.mapInArrow(_count_words(salt), "lang string, h long, low long, high long, n long").groupBy("lang", "h")
                   .agg(F.sum("n").alias("n"), (F.min("low") != F.max("high")).alias("shared")))
        # the words below the wanted frequency matter in the totals only
        counted = checkpointed(counted.groupBy("lang", F.when((F.col("n") >= least) | F.col("shared"), F.col("h")).alias("h"))
                               .agg(F.sum("n").alias("n"), F.max("shared").alias("shared")))
        if not counted.where("shared").head(1):
            break
    else:
        raise RuntimeError("words share hashes under every salt")
    return counted.groupBy("lang").agg(F.sum("n").alias("n")), counted.where("h is not null").select("lang", "h"), salt


def _count_level(rows: DataFrame, level: DataFrame, k: int, salt: int, extend: bool) -> DataFrame:
    """``id, next, word, n``: occurrences of the level's phrases (``next`` null) and of the safe windows."""
    blocks = max(1, -(-level.count() // BLOCK_PHRASES))
    out = None
    for b in range(blocks):
        # a block's phrases at most are on the driver at a time
        part = level.where(_block_of(F.col("words"), k, blocks) == b).select("id", "lang", "words").toArrow()
        if not part.num_rows:
            continue
        hashes = part["words"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, k)
        trie = Trie.build(part["lang"].to_pylist(), hashes)
        shared = rows.sparkSession.sparkContext.broadcast((part["id"].to_numpy(), trie))
        found = rows.mapInArrow(_count_phrases(shared, b, blocks, salt, extend), "id long, next long, word string, n long")
        out = found if out is None else out.unionByName(found)
    return out.groupBy("id", "next", "word").agg(F.sum("n").alias("n"))


def mine(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, text_col: str = "text",
         lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best-scored collocations of each language.

    Phrases of 2 to ``longest`` words that occur ``least`` times or more, cut where
    floor(1000 * a * n / (l * r)) is least; phrases that occur only inside a longer one go. A null
    text is empty, a null language ``und``; repeated rows count each; ties follow a, then the
    phrase; other columns are ignored, whatever their names. Empty tables give no rows.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    totals, words, salt = _words(rows, least)
    level = words.select(F.monotonically_increasing_id().alias("id"), "lang", F.array("h").alias("words"),
                         F.lit("").alias("phrase"))
    levels = []
    for k in range(1, longest + 1):
        if not level.head(1):
            break
        found = _count_level(rows, level, k, salt, extend=k < longest)
        found = checkpointed(found.where(F.col("next").isNull() | (F.col("n") >= least)))
        level = level.join(found.where(F.col("next").isNull()).select("id", "word", "n"), "id").where(F.col("n") >= least)
        if k == 1:
            level = checkpointed(level.withColumn("phrase", F.col("word")))
            following = level.select("lang", F.col("words")[0].alias("next"), F.col("word").alias("more"))
        levels.append(level.select("lang", "words", "phrase", F.col("n").alias("f"), F.lit(k).alias("k")))
        longer = (found.where(F.col("next").isNotNull()).select("id", "next").join(level.drop("n", "word"), "id").join(following, ["lang", "next"])
                  .select("lang", F.concat("words", F.array("next")).alias("words"), F.concat_ws(" ", "phrase", "more").alias("phrase")))
        level = checkpointed(longer).select(F.monotonically_increasing_id().alias("id"), "*")
    if len(levels) < 2:
        return docs.sparkSession.createDataFrame([], _SCHEMA)
    every = levels[0]
    for x in levels[1:]:
        every = every.unionByName(x)
    every = checkpointed(every)
    return _ranked(every, totals, top)


def _ranked(every: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """Scores at each phrase's weakest cut, without the phrases that a longer one covers."""
    candidates = every.where("k > 1")
    # what a longer phrase covers, a phrase one word longer covers too: its frequency lies between theirs
    inside = (every.where("k > 2").select("lang", "f", F.explode(F.array(
        F.expr("slice(words, 1, k - 1)"), F.expr("slice(words, 2, k - 1)"))).alias("words"))
        .groupBy("lang", "words").agg(F.max("f").alias("longer")))
    kept = (candidates.join(inside, ["lang", "words"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < 100 * F.col("f"))))
    cuts = kept.select("lang", "words", "phrase", F.col("f").alias("a"), F.explode(F.expr("sequence(1, k - 1)")).alias("cut"), "k")
    f = every.select("lang", "words", "f")
    cuts = (cuts.withColumn("left", F.expr("slice(words, 1, cut)")).withColumn("right", F.expr("slice(words, cut + 1, k - cut)"))
            .join(f.select("lang", F.col("words").alias("left"), F.col("f").alias("l")), ["lang", "left"])
            .join(f.select("lang", F.col("words").alias("right"), F.col("f").alias("r")), ["lang", "right"])
            .join(F.broadcast(totals), "lang"))  # one row a language
    # 38 digits hold both products; div is exact on them
    score = F.expr("(cast(1000 * a as decimal(19,0)) * cast(n as decimal(18,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(18,0)))")
    weakest = (cuts.withColumn("score", score.cast("long")).groupBy("lang", "words", "phrase", "a", "n")
               .agg(F.min(F.struct("score", "cut", "l", "r")).alias("m")))
    w = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (weakest.select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


MINE_SQL = r"""with piece as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p from documents),
w as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from piece),
total as (select lang, sum(len(w))::bigint as n from w group by lang),
grams as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
    from (select lang, k, w, unnest(range(1, len(w) - k + 2)) as i from w, (select unnest(range(1, 6)) as k))),
f as (select lang, k, phrase, count(*) as f from grams group by all having count(*) >= 100),
c as (select * from f where k > 1),
kept as (select * from c where not exists (select 1 from c as b where b.lang = c.lang and b.k > c.k and 100 * b.f >= 100 * c.f
    and contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))),
cut as (select lang, phrase, f as a, string_split(phrase, ' ') as w, unnest(range(1, k)) as cut from kept),
s as (select cut.lang, cut.phrase, a, cut, x.f as l, y.f as r, n, ((1000::hugeint * a * n) // (x.f::hugeint * y.f))::bigint as score
    from cut join total using (lang) join f as x on x.lang = cut.lang and x.phrase = array_to_string(w[1:cut], ' ')
    join f as y on y.lang = cut.lang and y.phrase = array_to_string(w[cut + 1:], ' ')),
m as (select * from s qualify row_number() over (partition by lang, phrase order by score, cut) = 1)
select lang, rank, phrase, a, l, r, n, score from (select *, row_number() over (partition by lang
    order by score desc, a desc, encode(phrase)) as rank from m) where rank <= 2000"""
