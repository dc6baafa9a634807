"""Word counts, vocabulary, encoding and decoding.

A vocabulary is a table ``(id, token, count)`` of at most ``size`` rows. Up to ``MAX_LOOKUP`` rows of it travel to
every task as one value; of a larger one the hashes do, up to ``largevocab.LARGE``. Beyond that only its head travels,
the most frequent tokens; what a row holds beside them is joined with the rest, distinct words of a row only, so
no frequent word is shuffled. The answer is the same in all three ways.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parlance.functions.text import words
from parlance.operators import largevocab
from parlance.operators.ranking import ordered_rank
from parlance.session import freeze, sent

# The reserved ids.
PAD, UNK, BOS, EOS = 0, 1, 2, 3
SPECIAL_TOKENS = ["<PAD>", "<UNK>", "<BOS>", "<EOS>"]
SEP_TOKEN = "<SEP>"
VOCAB_SIZE = 5000
MAX_LENGTH = 256
SLOTS = 1 << 14  # hash slots of a vocabulary lookup
MAX_LOOKUP = 500_000  # tokens; some tens of MB in every task
HEAD = 50_000  # tokens of a larger vocabulary that travel as one value


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """``token, count`` over whole texts."""
    return (
        df.select(F.explode(words(F.col(text))).alias("token"))
        .groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    )


def _special_rows(df: DataFrame) -> DataFrame:
    entries = F.array(*[
        F.struct(F.lit(i).alias("id"), F.lit(t).alias("token"), F.lit(0).cast("bigint").alias("count"))
        for i, t in enumerate(SPECIAL_TOKENS)
    ])
    return df.sparkSession.range(1).select(F.inline(entries))


def build_vocab(df: DataFrame, text: str, size: int = VOCAB_SIZE) -> DataFrame:
    """Special tokens, then the most frequent words; equal counts by token.

    The top words are cut first (a bounded heap per task), then numbered. A vocabulary that is too large to
    travel as one value is counted by hash and numbered by range partitions instead, without a task that holds it
    all; if its size leaves out too few words for that, all of them are counted and numbered.
    """
    counts, n = word_counts(df, text), size - len(SPECIAL_TOKENS)
    if size > MAX_LOOKUP:
        ranked = largevocab.top_words(df, text, n) if size <= largevocab.LARGE else None
        written = ranked is not None
        if not written:
            ranked = ordered_rank(freeze(counts), [("count", False), ("token", True)]).where(F.col("rank") < n)
        ranked = ranked.select((F.col("rank") + len(SPECIAL_TOKENS)).cast("int").alias("id"), "token", "count")
        vocab = _special_rows(df).unionByName(ranked)
        vocab._frozen = written  # read from what was written, so it need not be written again
        return vocab
    else:
        top = counts.orderBy(F.desc("count"), "token").limit(n)
        rank = F.row_number().over(Window.orderBy(F.desc("count"), "token"))  # over at most ``size`` rows
        ranked = top.select((rank + (len(SPECIAL_TOKENS) - 1)).cast("int").alias("id"), "token", "count")
    return _special_rows(df).unionByName(ranked)


def with_separator(vocab: DataFrame) -> DataFrame:
    """Add ``<SEP>`` with the next free id unless the vocabulary has it already."""
    row = vocab.agg(
        F.count(F.lit(1)).cast("int").alias("id"),
        F.lit(SEP_TOKEN).alias("token"),
        F.lit(0).cast("bigint").alias("count"),
        F.count_if(F.col("token") == SEP_TOKEN).alias("present"),
    )
    return vocab.unionByName(row.where(F.col("present") == 0).drop("present"))


def _way(vocab: DataFrame) -> str:
    """How the (written) vocabulary travels: as one ``value``, its ``hashes``, or its ``head``; counted before anything is gathered."""
    size = vocab.count()
    return "value" if size <= MAX_LOOKUP else "hashes" if size <= largevocab.LARGE else "head"


def _slot(token: Column | str) -> Column:
    return F.pmod(F.hash(token), F.lit(SLOTS))


def _id_lookup(vocab: DataFrame) -> DataFrame:
    """One row, one array: at each hash slot the small map of the tokens that fall there.

    The size is bounded by the vocabulary, so it travels as a scalar subquery, and a word is
    found in one or two comparisons instead of a scan of a map of thousands of entries.
    """
    entry = F.struct("token", "id")
    filled = vocab.select(_slot("token").alias("slot"), entry.alias("entry"))
    empty = vocab.sparkSession.range(SLOTS).select(
        F.col("id").cast("int").alias("slot"), F.lit(None).cast(filled.schema["entry"].dataType).alias("entry")
    )
    slots = filled.unionByName(empty).groupBy("slot").agg(F.collect_list("entry").alias("entries"))
    in_order = F.array_sort(F.collect_list(F.struct("slot", "entries")))
    return slots.agg(F.transform(in_order, lambda s: F.map_from_entries(s["entries"])).alias("lookup"))


def _pick(maps: Column, key: Column, slots: Column) -> Column:
    """The value of a key in a map of small maps; as many of them as each holds entries, so both searches are short."""
    return F.try_element_at(F.try_element_at(maps, _of(key, slots)), key)


def _of(key: Column, slots: Column) -> Column:
    return F.pmod(F.hash(key), slots)


def _joined_lookup(df: DataFrame, arrays: list[str], wanted: Callable[[Column], Column], table: DataFrame) -> DataFrame:
    """Add ``_maps``, what the table (key, value) says of a row's own keys, and ``_slots`` to look it up with.

    ``wanted`` tells for an array which of its entries are to be sought. Distinct keys of a row go to the join, so
    neither texts nor positions are exploded; the row's answers come back as one value. Rows are written once with a number.
    """
    own = F.array_distinct(F.flatten(F.array(*[wanted(F.col(f"`{a}`")) for a in arrays])))
    rows = freeze(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), own.alias("_own"), F.monotonically_increasing_id().alias("_rid")))
    slots = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("_own")))).cast("int")
    asked = rows.select("_rid", slots.alias("_slots"), F.explode("_own").alias("key"))
    found = asked.join(table.select("key", "value"), "key")
    entries = lambda k, v: F.map_from_entries(F.collect_list(F.struct(k, v)))
    small = found.groupBy("_rid", _of(F.col("key"), F.col("_slots")).alias("_slot")).agg(entries("key", "value").alias("_map"))
    maps = small.groupBy("_rid").agg(entries("_slot", "_map").alias("_maps"))
    return rows.withColumn("_slots", slots).join(maps, "_rid", "left").select("_row.*", "_maps", "_slots")


def word_ids(df: DataFrame, word_arrays: list[str], vocab: DataFrame) -> DataFrame:
    """Replace arrays of words by arrays of ids, unknown words by the UNK id.

    With a vocabulary that travels as one value, or whose hashes do, this is a narrow projection: texts are neither
    exploded nor shuffled. With a larger one, words outside its head are joined.
    """
    vocab = freeze(vocab)
    way = _way(vocab)
    if way != "value":
        find = largevocab.id_finder(vocab, UNK) if way == "hashes" else None
        return _word_ids_by_join(df, word_arrays, vocab) if find is None else _word_ids_by_hash(df, word_arrays, find)
    find = lambda w: F.coalesce(F.col("_lookup")[_slot(w)][w], F.lit(UNK))
    # one reference to the lookup, so that Spark folds it into this projection
    found = F.transform(F.array(*word_arrays), lambda ws: F.transform(ws, find))
    others = [c for c in df.columns if c not in word_arrays]
    return (
        df.withColumn("_lookup", _id_lookup(vocab).scalar())
        .select(*others, found.alias("_found"))
        .select(*others, *[F.col("_found")[i].alias(c) for i, c in enumerate(word_arrays)])
    )


def _word_ids_by_hash(df: DataFrame, word_arrays: list[str], find: Callable[[Column], Column]) -> DataFrame:
    """Ids found by the words' hashes; only these go to the Python task."""
    others = [c for c in df.columns if c not in word_arrays]
    return sent(df).select(*others, *[find(F.col(c)).alias(c) for c in word_arrays])


def _word_ids_by_join(df: DataFrame, word_arrays: list[str], vocab: DataFrame) -> DataFrame:
    """Ids of the head's words by the value; the others keep their word until it was joined."""
    others = [c for c in df.columns if c not in word_arrays]
    known = lambda w: F.struct(F.col("_lookup")[_slot(w)][w].alias("id"), w.alias("word"))
    found = F.transform(F.array(*word_arrays), lambda ws: F.transform(ws, known))
    headed = (
        df.withColumn("_lookup", _id_lookup(vocab.where(F.col("id") < HEAD)).scalar())
        .select(*others, found.alias("_found"))
        .select(*others, *[F.col("_found")[i].alias(c) for i, c in enumerate(word_arrays)])
    )
    unknown = lambda ws: F.filter(ws, lambda w: w["id"].isNull())["word"]
    tail = vocab.where(F.col("id") >= HEAD).select(F.col("token").alias("key"), F.col("id").alias("value"))
    joined = _joined_lookup(headed, word_arrays, unknown, tail)
    place = lambda w: F.coalesce(w["id"], _pick(F.col("_maps"), w["word"], F.col("_slots")), F.lit(UNK))
    return joined.select(*others, *[F.transform(c, place).alias(c) for c in word_arrays])


def _specials(*ids: int) -> Column:
    return F.array(*[F.lit(i) for i in ids])


def encode(df: DataFrame, key: str, text: str, vocab: DataFrame, max_length: int | None = MAX_LENGTH,
           keep_eos: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key, ids`` (and the ``keep`` columns): BOS, word ids, EOS, at most ``max_length`` long.

    By default the finished sequence is cut, which may cost the EOS; ``keep_eos`` cuts the
    words instead; ``None`` encodes whole texts. Words that cannot appear are not looked up.
    """
    limit = None if max_length is None else max_length - (2 if keep_eos else 1)
    vocab = freeze(vocab)
    late = _way(vocab) == "hashes"  # a condition before that lookup would have texts computed twice, if they are
    given = df if late else df.where(F.col(text).isNotNull())
    parts = given.select(key, *keep, words(F.col(text), limit).alias("ids"))
    sequence = F.concat(_specials(BOS), F.col("ids"), _specials(EOS))
    if max_length is not None:
        sequence = F.slice(sequence, 1, max_length)
    found = word_ids(parts, ["ids"], vocab)
    return (found.where(F.col("ids").isNotNull()) if late else found).select(key, *keep, sequence.alias("ids"))


def decode(df: DataFrame, key: str, ids: str, vocab: DataFrame) -> DataFrame:
    """``key, text``: tokens joined by blanks without PAD, BOS and EOS; unknown ids give ``<UNK>``.

    Vocabulary ids are 0, 1, 2, ..., so the tokens in id order are an array indexed by id; one too large for one value
    goes to Python tasks, of a still larger one only the head travels, and the distinct ids of a row beyond it are joined.
    """
    shown = F.filter(F.col(ids), lambda i: ~i.isin(PAD, BOS, EOS))
    unknown, vocab = F.lit(SPECIAL_TOKENS[UNK]), freeze(vocab)
    way = _way(vocab)
    whole = way == "value"
    if way == "hashes":
        find = largevocab.text_finder(vocab, SPECIAL_TOKENS[UNK])
        return sent(df).select(key, shown.alias("_shown")).select(key, find(F.col("_shown")).alias("text"))
    head = vocab if whole else vocab.where(F.col("id") < HEAD)
    tokens = head.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "token"))), lambda e: e["token"])).scalar()
    rows = df.select(key, shown.alias("_shown"))
    if whole:
        find = lambda i: F.coalesce(F.get(F.col("_tokens"), i), unknown)
    else:
        tail = vocab.where(F.col("id") >= HEAD).select(F.col("id").alias("key"), F.col("token").alias("value"))
        rows = _joined_lookup(rows, ["_shown"], lambda a: F.filter(a, lambda i: i >= HEAD), tail)
        find = lambda i: F.coalesce(F.get(F.col("_tokens"), i), _pick(F.col("_maps"), i, F.col("_slots")), unknown)
    return rows.withColumn("_tokens", tokens).select(key, F.array_join(F.transform("_shown", find), " ").alias("text"))
