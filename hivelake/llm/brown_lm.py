"""Brown class-based bigram model: exchange clustering, class transitions and word emissions.

Every word belongs to one class, so ``P(w | v) = P(class w | class v) * P(w | class w)``.  The ``exchange_words``
most frequent words seed the classes by exchange clustering, which moves one word at a time to the class that
raises the likelihood of the class bigrams most.  Every other word that occurs ``EVIDENCE`` times, however many
there are, then joins the class that raises it most: tasks gather how often each class stands before and after
each such word, and all words choose at once, in ``ASSIGN_PASSES`` passes over the texts.  Only words too rare
for that, and unseen ones, belong to the class of their shape: length, last character, digits and letters
beyond ASCII.  Word counts, class counts and class bigrams are counted over every training text.

Transitions are smoothed towards the class frequencies, and in each class half a count goes to every seen
word and to one slot for the unseen, so the probabilities of each class sum to 1.

Counts of the most frequent words, a bounded number, are sent to every task; the others meet the counts by a
join on the words' hash, so one frequent word never fills a partition.  The classes of all learnt words are sent
to every task, ten bytes a word; they grow with the corpus, at most by one word for ``EVIDENCE`` tokens.

Cases: a null or empty text is its end token alone; a null id counts as the empty string where ids are dealt
into training and held-out rows.  Repeated rows are scored each.  Without training rows every word is unseen.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._sample import from_the_top
from ._scratch import written
from ._text import Lookup, Words, mix, word_slices

#: Words that seed the classes by exchange clustering, and the classes.
EXCHANGE_WORDS, EXCHANGE_CLASSES, EXCHANGE_PASSES = 512, 48, 12
#: Occurrences from which a word chooses its class by its neighbours, and the passes of choosing.
EVIDENCE, ASSIGN_PASSES = 16, 2
#: Words whose counts are sent to every task.
FREQUENT_WORDS = 1 << 18
#: Counts by which a transition leans on the frequency of the class it leads to.
LEAN = 20.0
#: Rows that repeat an id and a text are made of their common score, so many at once.
COPIES_AT_ONCE = 1 << 16
#: Words that a counting task holds before it passes them on.
PENDING = 1 << 20

#: Classes by shape: five lengths, four endings, digits or not, ASCII or not.
SHAPES = 5 * 4 * 2 * 2


def shape_of(words: Words) -> np.ndarray:
    """The shape class of each word, a function of its (lower-case) bytes alone."""
    size = words.end - words.start
    last = words.raw[words.end - 1] if len(size) else np.zeros(0, np.uint8)
    ending = np.select([last == ord("."), last == ord(","), (last >= 128) | np.isin(last | 32, np.arange(ord("a"), ord("z") + 1))], [1, 2, 0], 3)
    within = lambda flags: (lambda s: s[words.end] > s[words.start])(np.concatenate([[0], np.cumsum(flags)]))
    digit = within((words.raw >= ord("0")) & (words.raw <= ord("9")))
    beyond = within(words.raw >= 128)
    return np.digitize(size, [3, 5, 7, 10]) + 5 * (ending + 4 * (digit + 2 * beyond))


def held_out(id_: Column, folds: int = 5, fold: int = 1) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % folds == fold


def _merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h, shape, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    keys, first, code = np.unique(h, return_index=True, return_inverse=True)
    return keys, shape[first], np.bincount(code, n, len(keys)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(word, shape, count)`` of the texts, added up as far as a task holds them."""

    def out(part: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), pa.array(part[1].astype(np.int32)), pa.array(part[2])], names=["h", "shape", "c"])

    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    waiting = 0
    for batch in batches:
        for _, _, words in word_slices(batch.column(0), lower=True):
            if len(words.hash):
                held.append(_merged([(words.hash, shape_of(words), np.ones(len(words.hash)))]))
                waiting += len(held[-1][0])
            if waiting > PENDING:
                held = [_merged(held)]
                waiting = len(held[0][0])
                if waiting > PENDING // 2:
                    yield out(held.pop())
                    waiting = 0
    if held:
        yield out(_merged(held))


def _symbols(words: Words, places: np.ndarray, symbol: np.ndarray, of_shape: np.ndarray) -> np.ndarray:
    """The symbol of each known word, and that of its shape for any other."""
    out = of_shape[shape_of(words)]
    hit = places >= 0
    out[hit] = symbol[places[hit]]
    return out


def _with_ends(values: np.ndarray, words: Words, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's tokens with its end token, what stands before each of them, and each one's row."""
    counts = words.counts()
    rows = np.repeat(np.arange(words.n_rows), counts + 1)
    tokens = np.full(len(rows), end)
    tokens[np.arange(len(values)) + words.row] = values
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]  # the last text's end stands before a text, as a text's start
    if len(before):
        before[0] = end
    return tokens, before, rows


def _bigrams(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    known, symbol, of_shape, size = shared.value
    total = np.zeros(size * size, np.int64)
    for batch in batches:
        for _, _, words in word_slices(batch.column(0), lower=True):
            tokens, before, _ = _with_ends(_symbols(words, known.places(words.hash), symbol, of_shape), words, size - 1)
            total += np.bincount(before * size + tokens, minlength=size * size)
    pair = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(total[pair])], names=["pair", "n"])


def _bigram_matrix(texts: DataFrame, known: np.ndarray, symbol: np.ndarray, of_shape: np.ndarray, size: int) -> np.ndarray:
    """How often each symbol follows each; the last symbol is the end of a text."""
    shared = texts.sparkSession.sparkContext.broadcast((Lookup(known), symbol, of_shape, size))
    pairs = texts.mapInArrow(lambda it: _bigrams(it, shared), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size * size)
    out[pairs["pair"].to_numpy(np.int64)] = pairs["n"].to_numpy(np.float64)
    return out.reshape(size, size)


def _neighbours(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    """``(word, beside, n)``: how often a class stands before a word that chooses, after it, or the word itself.

    ``beside`` is the class before, or ``size`` more than the class after, or ``2 * size`` for the word itself.
    """
    known, label, of_shape, size, chooses = shared.value
    codes = 2 * size + 1

    def out(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array((keys // codes).astype(np.int32)), pa.array((keys % codes).astype(np.int16)), pa.array(n)], names=["word", "beside", "n"])

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, code = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(code, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    for batch in batches:
        for _, _, words in word_slices(batch.column(0), lower=True):
            places = known.places(words.hash)
            classes, before, _ = _with_ends(_symbols(words, places, label, of_shape), words, size - 1)
            own, own_before, _ = _with_ends(places, words, -1)
            again = (own >= 0) & (own == own_before)
            left = np.flatnonzero((own >= 0) & chooses[own] & ~again)
            right = np.flatnonzero((own_before >= 0) & chooses[own_before] & ~again)
            twice = np.flatnonzero(again & chooses[own])
            keys = np.concatenate([own[left] * codes + before[left], own_before[right] * codes + size + classes[right], own[twice] * codes + 2 * size])
            if len(keys):
                held.append(np.unique(keys, return_counts=True))
                waiting += len(held[-1][0])
            if waiting > PENDING:
                held = [merged(held)]
                waiting = len(held[0][0])
                if waiting > PENDING // 2:
                    yield out(*held.pop())
                    waiting = 0
    if held:
        yield out(*merged(held))


def best_classes(n: np.ndarray, targets: int, own: np.ndarray, before: np.ndarray, after: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """For each word, the class below ``targets`` that makes the class bigrams ``n`` most likely if it alone moves.

    ``own`` are the words' classes, ``before`` and ``after`` how often each class stands beside each word, other
    than the word itself, and ``twice`` how often the word follows itself.
    """
    m, d = len(own), np.arange(targets)
    gain = np.zeros((m, targets))
    inside = np.flatnonzero(own < targets)

    def side(matrix: np.ndarray, counts: np.ndarray, others: np.ndarray) -> None:
        """Adds the cells of ``matrix[b, c]`` to which the words' ``counts[c]`` go."""
        for first in range(0, m, 256):
            w, c = np.nonzero(counts[first : first + 256])
            w += first
            if not len(w):
                continue
            cells = matrix[:targets].T[c]
            at_own = c == own[w]
            cells[at_own] -= others[w[at_own], :targets]
            leaves = np.flatnonzero(own[w] < targets)
            cells[leaves, own[w[leaves]]] -= counts[w[leaves], c[leaves]] + at_own[leaves] * twice[w[leaves]]
            more = _xlogx(cells + counts[w, c][:, None]) - _xlogx(cells)
            begins = np.flatnonzero(np.diff(w, prepend=-1))
            gain[w[begins]] += np.add.reduceat(more, begins)

    side(n, after, before)
    side(n.T, before, after)
    diagonal = np.repeat(n[d, d][None], m, 0)
    diagonal[inside, own[inside]] -= after[inside, own[inside]] + before[inside, own[inside]] + twice[inside]
    r, k = after[:, :targets], before[:, :targets]
    gain += _xlogx(diagonal + r + k + twice[:, None]) + _xlogx(diagonal) - _xlogx(diagonal + r) - _xlogx(diagonal + k)
    for sums, counts in ((n.sum(1), after), (n.sum(0), before)):
        all_ = counts.sum(1) + twice
        rest = np.repeat(sums[None, :targets], m, 0)
        rest[inside, own[inside]] -= all_[inside]
        gain -= _xlogx(rest + all_[:, None]) - _xlogx(rest)
    best = gain.argmax(1)
    stays = inside[gain[inside, best[inside]] <= gain[inside, own[inside]] + 1e-9]
    best[stays] = own[stays]
    return best


def _chosen(batches: Iterator[pa.RecordBatch], shared: Broadcast, words: int = 2048) -> Iterator[pa.RecordBatch]:
    """The class of each word of ``(word, beside, n)`` rows, which are ordered by word."""
    n, targets, label = shared.value
    size = len(n)

    def out(word: np.ndarray, beside: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        own, row = np.unique(word, return_inverse=True)
        found = []
        for a in range(0, len(own), words):
            part = (row >= a) & (row < a + words)
            dense = np.zeros((min(words, len(own) - a), 2 * size + 1))
            dense[row[part] - a, beside[part]] = count[part]
            found.append(best_classes(n, targets, label[own[a : a + words]], dense[:, :size], dense[:, size : 2 * size], dense[:, 2 * size]))
        return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(np.concatenate(found), pa.int32())], names=["word", "class"])

    held = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        held = [np.concatenate([old, batch.column(i).to_numpy().astype(np.int64)]) for i, old in enumerate(held)]
        if len(held[0]) and held[0][0] != held[0][-1]:
            cut = np.searchsorted(held[0], held[0][-1])  # the last word may go on
            yield out(*(x[:cut] for x in held))
            held = [x[cut:] for x in held]
    if len(held[0]):
        yield out(*held)


def _assigned(texts: DataFrame, n: np.ndarray, targets: int, known: np.ndarray, label: np.ndarray, of_shape: np.ndarray, chooses: np.ndarray) -> np.ndarray:
    """The labels after every word that ``chooses`` has taken its best class at once."""
    context = texts.sparkSession.sparkContext
    shared, model = context.broadcast((Lookup(known), label, of_shape, len(n), chooses)), context.broadcast((n, targets, label))
    beside = texts.mapInArrow(lambda it: _neighbours(it, shared), "word int, beside short, n long").repartition("word").groupBy("word", "beside").agg(F.sum("n").alias("n"))
    best = beside.sortWithinPartitions("word").mapInArrow(lambda it: _chosen(it, model), "word int, class int").toArrow()
    label = label.copy()
    label[best["word"].to_numpy()] = best["class"].to_numpy()
    return label


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, n_words: int, n_classes: int, passes: int = EXCHANGE_PASSES) -> np.ndarray:
    """The class of every symbol; the symbols from ``n_words`` on keep a class each."""
    size = len(bigrams)
    n_classes = min(n_classes, n_words)
    label = np.concatenate([np.arange(n_words) % max(1, n_classes), n_classes + np.arange(size - n_words)])
    total = n_classes + size - n_words
    member = np.zeros((size, total))
    member[np.arange(size), label] = 1
    out, into = bigrams @ member, member.T @ bigrams
    n = member.T @ out
    rows, columns = bigrams.sum(1), bigrams.sum(0)
    for _ in range(passes):
        moved = 0
        for w in range(n_words):
            a, own = label[w], bigrams[w, w]
            r, k = out[w].copy(), into[:, w].copy()
            r[a] -= own
            k[a] -= own
            n[a] -= r
            n[:, a] -= k
            n[a, a] -= own
            left, right = n.sum(1)[:n_classes], n.sum(0)[:n_classes]
            top, side, d = n[:n_classes], n[:, :n_classes], np.arange(n_classes)
            gain = (_xlogx(top + r) - _xlogx(top)).sum(1) + (_xlogx(side + k[:, None]) - _xlogx(side)).sum(0)
            diag = n[d, d]
            gain += _xlogx(diag + r[:n_classes] + k[:n_classes] + own) + _xlogx(diag) - _xlogx(diag + r[:n_classes]) - _xlogx(diag + k[:n_classes])
            gain -= _xlogx(left + rows[w]) - _xlogx(left) + _xlogx(right + columns[w]) - _xlogx(right)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            n[b] += r
            n[:, b] += k
            n[b, b] += own
            if b != a:
                moved += 1
                label[w] = b
                out[:, a] -= bigrams[:, w]
                out[:, b] += bigrams[:, w]
                into[a] -= bigrams[w]
                into[b] += bigrams[w]
        if not moved:
            break
    return label


@dataclass
class BrownModel:
    """What scoring needs: the counts of all words, in a table, and small arrays for every task."""

    counts: DataFrame  # h, shape, c
    n_tokens: int
    n_types: int
    n_ends: int
    frequent: np.ndarray  # hashes, ascending
    frequent_counts: np.ndarray
    known: np.ndarray  # hashes of the words with a class of their own choice, ascending
    label: np.ndarray  # their classes
    of_shape: np.ndarray  # class of each shape
    transition: np.ndarray  # log10 P(class | class before)
    within: np.ndarray  # log10 of each class's emission denominator

    @property
    def log_total(self) -> float:
        return float(np.log10(self.n_tokens + 0.5 * (self.n_types + 1)))


def fit(
    train: DataFrame,
    text_col: str = "text",
    *,
    exchange_words: int = EXCHANGE_WORDS,
    exchange_classes: int = EXCHANGE_CLASSES,
    frequent_words: int = FREQUENT_WORDS,
    evidence: int = EVIDENCE,
    assign_passes: int = ASSIGN_PASSES,
) -> BrownModel:
    """Learn the model from every row of ``train``."""
    texts = train.select(F.col(text_col).alias("text"))
    counts = texts.mapInArrow(_counted, "h long, shape int, c long").groupBy("h").agg(F.max("shape").alias("shape"), F.sum("c").alias("c"))
    counts = written(counts, "words")
    n_ends = train.count()
    top = from_the_top(counts, F.floor(F.log2("c") * 16).cast("int"), frequent_words).select("h", "c").toPandas()
    h, c = top["h"].to_numpy().view(np.uint64), top["c"].to_numpy()
    order = np.argsort(h)
    seeds = counts.orderBy(F.desc("c"), "h").limit(exchange_words).collect()
    seed_h = np.array([r["h"] for r in seeds], np.int64).view(np.uint64)
    n_exchange = len(seeds)
    size = n_exchange + SHAPES + 1
    by_hash = np.argsort(seed_h)
    bigrams = _bigram_matrix(texts, seed_h[by_hash], by_hash, n_exchange + np.arange(SHAPES), size)
    of_symbol = exchange(bigrams, n_exchange, exchange_classes)

    n_classes = int(of_symbol.max()) + 1
    member = np.zeros((size, n_classes))
    member[np.arange(size), of_symbol] = 1
    n = member.T @ bigrams @ member
    of_shape = of_symbol[n_exchange:-1]
    more = counts.where(F.col("c") >= evidence).select("h", "shape").toArrow()
    more_h, more_shape = more["h"].to_numpy().view(np.uint64), more["shape"].to_numpy()
    fresh = ~np.isin(more_h, seed_h)
    known = np.concatenate([seed_h, more_h[fresh]])
    label = np.concatenate([of_symbol[:n_exchange], of_shape[more_shape[fresh]]]).astype(np.int16)
    by_hash = np.argsort(known)
    known, label, chooses = known[by_hash], label[by_hash], (np.arange(len(known)) >= n_exchange)[by_hash]
    for _ in range(assign_passes if chooses.any() else 0):
        new = _assigned(texts, n, n_classes - SHAPES - 1, known, label, of_shape, chooses)
        if (new == label).all():
            break
        label = new
        n = _bigram_matrix(texts, known, label, of_shape, n_classes)
    tokens = n.sum(0)
    share = (tokens + 0.5) / (tokens.sum() + 0.5 * n_classes)
    transition = np.log10((n + LEAN * share) / (n.sum(1, keepdims=True) + LEAN))

    by_shape = counts.groupBy("shape").agg(F.count(F.lit(1)).alias("v"), F.count(F.when(F.col("c") < evidence, 1)).alias("rare"), F.sum("c").alias("c")).collect()
    types = np.bincount(label, minlength=n_classes).astype(float)
    for r in by_shape:
        types[of_shape[r["shape"]]] += r["rare"] - sum(1 for s in seeds if s["shape"] == r["shape"] and s["c"] < evidence)
    types[-1] = 1
    return BrownModel(
        counts=counts,
        n_tokens=int(sum(r["c"] for r in by_shape)) + n_ends,
        n_types=int(sum(r["v"] for r in by_shape)) + (n_ends > 0),
        n_ends=n_ends,
        frequent=h[order],
        frequent_counts=c[order],
        known=known,
        label=label,
        of_shape=of_shape,
        transition=transition,
        within=np.log10(tokens + 0.5 * (types + 1)),
    )


def _scored(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    """A row for each text, with all that needs no join, and one for each of its rarer words.

    Columns: id and key as they came; h, the word or a number spread over the partitions; tf, 0 for a text.
    """
    frequent, log_c, known, label, of_shape, transition, within, log_end, ends = shared.value
    end_class = len(within) - 1
    for batch in batches:
        key = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b, words in word_slices(batch.column(2), lower=True):
            n = b - a
            classes = _symbols(words, known.places(words.hash), label, of_shape)
            tokens, before, rows = _with_ends(classes, words, end_class)
            moves = np.bincount(rows, transition[before, tokens] - within[tokens], n)
            at = frequent.places(words.hash)
            hit = at >= 0
            counted = np.bincount(words.row[hit], log_c[at[hit]], n) + log_end
            n_known = np.bincount(words.row[hit], minlength=n) + (ends > 0)
            rare, rare_row = words.hash[~hit], words.row[~hit]
            order = np.lexsort((rare, rare_row))
            rare, rare_row = rare[order], rare_row[order]
            new = np.ones(len(rare), bool)
            new[1:] = (rare[1:] != rare[:-1]) | (rare_row[1:] != rare_row[:-1])
            first = np.flatnonzero(new)
            tf = np.diff(np.append(first, len(rare)))
            m = len(first)
            own = np.concatenate([np.arange(a, b), a + rare_row[first]])
            h = np.concatenate([mix(key[a:b].view(np.uint64)), rare[first]]).view(np.int64)
            pad = lambda x: pa.array(np.concatenate([x, np.zeros(m, x.dtype)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(own)), pa.array(key[own]), pa.array(h), pa.array(np.concatenate([np.zeros(n, np.int64), tf])), pad(words.counts().astype(np.int64) + 1), pad(n_known.astype(np.int64)), pad(counted), pad(moves)],
                names=["id", "key", "h", "tf", "n_tokens", "n_known", "counted", "moves"],
            )


def score(df: DataFrame, model: BrownModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row."""
    half = np.log10(0.5 + model.n_ends)
    shared = df.sparkSession.sparkContext.broadcast(
        (Lookup(model.frequent), np.log10(model.frequent_counts + 0.5), Lookup(model.known), model.label, model.of_shape, model.transition, model.within, half, model.n_ends)
    )
    # rows are known by their id and text, so that any task may run again; rows that repeat both score alike
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"), F.col(text_col).alias("text"))
    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, key long, h long, tf long, n_tokens long, n_known long, counted double, moves double"
    parts = rows.mapInArrow(lambda it: _scored(it, shared), schema)
    parts = parts.join(model.counts.select("h", "c"), "h", "left")
    rare = F.col("tf") > 0
    parts = parts.select(
        "id",
        "key",
        "n_tokens",
        F.when(rare, 0).otherwise(1).alias("copies"),
        F.when(rare, F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).otherwise(F.col("n_known")).alias("n_known"),
        F.when(rare, F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).otherwise(F.col("counted")).alias("counted"),
        "moves",
    )
    sums = ("copies", "n_known", "counted", "moves")
    out = parts.groupBy("id", "key").agg(F.max("n_tokens").alias("n_tokens"), *(F.sum(c).alias(c) for c in sums))
    # a row for each copy again, some at a time
    some = F.least(F.lit(COPIES_AT_ONCE), F.col("copies") - F.col("at"))
    out = out.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(COPIES_AT_ONCE)))).withColumn("one", F.explode(F.sequence(F.lit(1), some)))
    return out.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (F.col("counted") / F.col("copies") - F.col("n_tokens") * F.lit(model.log_total)).alias("base_score"),
        ((F.col("counted") + F.col("moves")) / F.col("copies")).alias("score"),
    )


def score_held_out(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """Learn from the rows that are not held out and score all."""
    return score(df, fit(df.where(~held_out(F.col(id_col))), text_col, **options), id_col, text_col)
