"""Document fingerprints by order MinHash: minimal occurrence-numbered k-mers in text order, hashed as tuples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import table
from plumbline.operators.numbering import assign_ids
from plumbline.sources.staging import materialise

#: A letter of the sketch: a word, or 16 characters of a longer one.
UNIT = r"[^\x20\x09-\x0D]{1,16}"
GRAM = 3  # units of a k-mer
CHOSEN = 2  # k-mers of a tuple
#: Permutations, a power of two: entries of a fingerprint.
_ENTRY_BITS = 6
ENTRIES = 1 << _ENTRY_BITS
_TOP = 64 - _ENTRY_BITS
_OFFSET = 1 << 31  # an entry is the low half of a hash, kept as an int


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` reads it."""
    return F.transform(F.array(value), body)[0]


def _left(value: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", value, bits)


def _right(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits)


def gram_hashes(text: Column) -> Column:
    """Hashes of all k-mers of a text in order; fewer than ``GRAM`` units are one k-mer, none has none."""
    units = F.transform(F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)), lambda u: F.xxhash64(u))

    def grams(unit: Column) -> Column:
        n = F.size(unit)
        whole = F.transform(F.slice(unit, 1, n - (GRAM - 1)), lambda h, i: F.xxhash64(h, *[unit[i + k] for k in range(1, GRAM)]))
        return F.when(n >= GRAM, whole).when(n > 0, F.array(F.xxhash64(unit))).otherwise(F.array().cast("array<bigint>"))

    return let(units, grams)


def _occurrence_numbers(ordered: Column, bits: Column) -> Column:
    """For k-mers in order, each packed over its place: how many equal ones come before it."""
    begins = F.filter(
        F.transform(ordered, lambda x, i: F.when(F.when(i == 0, True).otherwise(_right(x, bits) != _right(ordered[i - 1], bits)), i)),
        lambda i: i.isNotNull(),
    )

    def numbers(begin: Column) -> Column:
        def run(start: Column, j: Column) -> Column:
            end = F.when(j + 1 < F.size(begin), begin[j + 1]).otherwise(F.size(ordered))
            return F.sequence(F.lit(0), end - start - 1)

        return F.flatten(F.transform(begin, run))

    return let(begins, numbers)


def order_minhash(text: Column) -> Column:
    """The fingerprint of a text: ``ENTRIES`` numbers.

    Each k-mer gets an occurrence number, and with it a hash. Entry j orders these by hash XOR j in the top bits, a
    permutation of its own; the ``CHOSEN`` smallest k-mers are put in text order and hashed as a tuple. Two texts agree
    in an entry about as often as their smallest k-mers and the order of these agree, which an edit far away from them
    leaves alone and a move does not.

    Hashes are sorted once: the smallest of entry j are the first in the run of hashes that begin with j. Where a run
    is too short, all first hashes of the runs are compared (XORed by j).
    """

    def pack(gram: Column, bits: Column) -> Column:
        place = _left(F.lit(1).cast("bigint"), bits) - 1
        ordered = F.sort_array(F.transform(gram, lambda h, i: _left(h, bits).bitwiseOR(i.cast("bigint"))))

        def hashed(inner: Column) -> Column:
            def numbered(number: Column) -> Column:
                def one(x: Column, i: Column) -> Column:
                    at = x.bitwiseAND(place)
                    return F.xxhash64(gram[at.cast("int")], number[i]).bitwiseAND(F.bitwise_not(place)).bitwiseOR(at)

                return F.sort_array(F.transform(inner, one))

            return let(_occurrence_numbers(inner, bits), numbered)

        return let(ordered, hashed)

    def run_of(x: Column) -> Column:
        return F.shiftright(x, _TOP) + F.lit(ENTRIES // 2)

    def entries(gram: Column, place: Column, packed: Column) -> Column:
        firsts = F.filter(packed, lambda x, i: F.when(i < CHOSEN, True).otherwise(run_of(x) != run_of(packed[i - CHOSEN])))

        def of(first: Column) -> Column:
            def by_run(runs: Column) -> Column:
                def entry(j: Column) -> Column:
                    def chosen(at: Column) -> Column:
                        last = at + (CHOSEN - 1)
                        own = F.when((at > 0) & (last <= F.size(runs)), runs[(last - 1).cast("int")] == j).otherwise(False)
                        flip = F.shiftleft(j, _TOP)
                        near = F.slice(F.sort_array(F.transform(first, lambda x: x.bitwiseXOR(flip))), 1, CHOSEN)
                        return F.when(own, F.slice(first, at.cast("int"), CHOSEN)).otherwise(near)

                    best = let(F.array_position(runs, j), chosen)
                    in_order = F.sort_array(F.transform(best, lambda x: x.bitwiseAND(place)))
                    tuple_hash = F.xxhash64(F.transform(in_order, lambda at: gram[at.cast("int")]))
                    return (tuple_hash.bitwiseAND(F.lit(2 * _OFFSET - 1)) - _OFFSET).cast("int")

                return F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(ENTRIES - 1).cast("bigint")), entry)

            return let(F.transform(first, run_of), by_run)

        return let(firsts, of)

    def sketch(gram: Column) -> Column:
        def with_bits(bits: Column) -> Column:
            place = _left(F.lit(1).cast("bigint"), bits) - 1
            return let(pack(gram, bits), lambda packed: entries(gram, place, packed))

        return let(F.length(F.bin(F.size(gram).cast("bigint"))), with_bits)

    return let(gram_hashes(text), sketch)


def as_text(fingerprint: Column) -> Column:
    """Eight hexadecimal digits per entry."""
    return F.array_join(F.transform(fingerprint, lambda e: F.lower(F.lpad(F.hex(e.cast("bigint") + _OFFSET), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal entries."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)
    return F.size(same) / F.lit(float(ENTRIES))


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """Add to ``doc_id`` and ``text`` of each row: ``n_chars``, ``fingerprint``."""
    return documents.select(
        "doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), as_text(order_minhash(F.coalesce("text", F.lit("")))).alias("fingerprint")
    )


def fingerprint_edits(documents: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next``.

    The edited text has its last half replaced by as much of the next text's beginning, in the order of ``doc_id``
    (nulls last, texts of one id by a digest; the first follows the last). Rows that agree in id and text are one group,
    worked on once: all but the last of them are followed by themselves. Groups are numbered on narrow rows over range
    partitions; texts are shuffled once by the group's digest, and of the next text only the part that is put in.

    Null texts are empty; an empty text has one fingerprint like any other. No rows: no rows. Other columns are left
    out. A text's k-mers are held by one task, in a few arrays of numbers (about 100 bytes a word at the peak).
    """
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", text.alias("text")).withColumn(
        "key", F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), "text")))
    )
    narrow = rows.select("key", "doc_id", F.length("text").cast("long").alias("n_chars"))
    groups = narrow.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.min("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    groups = assign_ids(groups, "place", 0, [F.col("doc_id").asc_nulls_last(), F.col("key")])
    groups, measured = materialise(groups, n=F.count(F.lit(1)))
    n = measured["n"] or 0
    after = groups.select(F.col("key").alias("next_key"), F.when(F.col("place") == 1, n).otherwise(F.col("place") - 1).alias("place"))
    plan, _ = materialise(groups.join(after, "place").select("key", "doc_id", "n_chars", "copies", "next_key"))

    once = rows.select("key", "text").groupBy("key").agg(F.any_value("text").alias("text"))
    taken = plan.select(F.col("key").alias("of"), F.col("next_key").alias("key"), F.expr("cast(n_chars div 2 as int)").alias("most"))
    heads = once.join(taken, "key").select(F.col("of").alias("key"), F.expr("substring(text, 1, most)").alias("head"))
    own = once.join(plan, "key").join(heads, "key")
    half = F.expr("cast(n_chars div 2 as int)")
    start = F.expr("substring(text, 1, cast(n_chars - n_chars div 2 as int))")
    last = F.struct(F.col("head"), F.lit(1).cast("long").alias("times"), F.col("next_key"))
    itself = F.struct(F.substring("text", F.lit(1), half).alias("head"), (F.col("copies") - 1).alias("times"), F.col("key").alias("next_key"))
    each = own.select(
        "key", "doc_id", "n_chars", "text", start.alias("start"),
        F.explode(F.when(F.col("copies") > 1, F.array(last, itself)).otherwise(F.array(last))).alias("then"),
    ).select("key", "doc_id", "n_chars", "text", "then.times", "then.next_key", F.concat("start", "then.head").alias("edited"))
    made = each.select(
        "key", "doc_id", "n_chars", "times", "next_key", F.sha2("edited", 256).alias("edited_sha256"),
        order_minhash(F.col("text")).alias("own"), order_minhash(F.col("edited")).alias("other"),
    )
    made, _ = materialise(made)
    following = made.groupBy(F.col("key").alias("next_key")).agg(F.any_value("own").alias("after"))
    return made.join(following, "next_key").select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("after")).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("_llm_copy"),
    ).drop("_llm_copy")


def op12_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
