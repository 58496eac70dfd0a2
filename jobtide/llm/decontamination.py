"""Benchmark decontamination by winnowing, in DataFrame functions only.

A shared span counts from ``SPAN`` words on.  Texts are winnowed: of the hashes of all
``GRAM``-word grams the smallest of every ``SPAN - GRAM + 1`` successive ones is kept, so two
texts that share ``SPAN`` words share a kept hash for that very span.  Kept hashes of documents
join those of the items; around the hits the spans themselves are compared, word for word.

Documents are cut into segments of ``SEGMENT`` span starts (overlapping by ``SPAN - 1`` words),
so a row stays small however long a text is.  Nothing about documents is collected; of the
benchmark only the lengths of items under ``SPAN`` words (at most nine numbers).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import let, lower_ascii, settle, steps, unused, without, workspace

SPAN = 10
GRAM = 6
SEGMENT = 16384
_DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(lowered: Column) -> Column:
    """Runs of letters, digits and anything beyond ASCII."""
    pieces = F.array_remove(F.split(lowered, _DELIMITERS), "")
    return F.coalesce(pieces, F.array().cast("array<string>"))


def _paired(a: Column, b: Column, shift: int, combine) -> Column:
    """``combine`` of each element of ``a`` and the one of ``b`` that stands ``shift`` later."""
    return F.zip_with(a, F.slice(b, shift + 1, F.size(b)), combine)


def _runs(values: Column, length: int, combine) -> Column:
    """``combine`` over every run of ``length`` elements, by doubling; null where one is short."""
    if length == 1:
        return values
    half = 1 << ((length - 1).bit_length() - 1)
    return let(
        _runs(values, half, combine),
        lambda part: _paired(part, part, length - half, combine),
    )


def _kept(run: Column) -> Column:
    """For each span of ``run``, which must be a column, the hash that winnowing keeps.

    A gram's hash is that of the hashes of two overlapping shorter grams.  Whole arrays are
    combined, as reading a run of elements at each place is slower.
    """
    width = SPAN - GRAM + 1
    pair = lambda x, y: F.xxhash64(x, y)
    least = lambda x, y: F.least(x, y)
    kept = let(
        F.transform(run, lambda w: F.xxhash64(w)),
        lambda h: let(_runs(h, GRAM, pair), lambda g: _runs(g, width, least)),
    )
    # Past the last whole span the shifted arrays were too short.
    return F.when(F.size(run) >= SPAN, F.slice(kept, 1, F.size(run) - (SPAN - 1))).otherwise(
        F.array().cast("array<bigint>")
    )


def _segments(run: Column) -> Column:
    return F.when(F.size(run) <= SEGMENT, F.array(run)).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.floor((F.size(run) - 1) / SEGMENT).cast("int")),
            lambda j: F.slice(run, j * SEGMENT + 1, SEGMENT + SPAN - 1),
        )
    )


def _span(run: Column, start: Column, length: int) -> Column:
    return F.concat_ws(" ", *[F.get(run, start + (k - 1)) for k in range(length)])


def _cut(text: Column) -> Column:
    """Segments of the words, which are hashed as they are compared.

    Full lower case would not do: that of a sigma depends on what stands around it.
    """
    return let(words(lower_ascii(text)), _segments)


def _item_windows(items: DataFrame) -> DataFrame:
    """``item``, ``length``, ``span`` and, for full spans, the kept hash ``fp``."""
    # The explode keeps the words from being split again inside the lambdas.
    run = items.select(
        F.col("item_id").cast("string").alias("item"),
        F.posexplode(_cut(F.col("text"))).alias("seg", "run"),
    )
    long = run.select(
        "item",
        F.explode(
            let(
                _kept(F.col("run")),
                lambda kept: F.transform(
                    steps(F.size("run") - (SPAN - 1)),
                    lambda i: F.struct(
                        _span(F.col("run"), i, SPAN).alias("span"), kept[i - 1].alias("fp")
                    ),
                ),
            )
        ).alias("w"),
    )
    short = run.where((F.col("seg") == 0) & (F.size("run") > 0) & (F.size("run") < SPAN))
    return (
        long.select("item", F.lit(SPAN).alias("length"), "w.span", "w.fp")
        .unionByName(
            short.select(
                "item",
                F.size("run").alias("length"),
                F.array_join("run", " ").alias("span"),
                F.lit(None).cast("bigint").alias("fp"),
            )
        )
        .distinct()
    )


def _covered(spans: Column) -> Column:
    """Number of words inside any of the (start, end) spans."""
    state = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("total"))
    return F.aggregate(
        F.array_sort(spans),
        state,
        lambda seen, span: F.struct(
            F.greatest(seen["end"], span["end"]).alias("end"),
            (
                seen["total"]
                + F.greatest(span["end"] - F.greatest(seen["end"], span["start"]), F.lit(0))
            ).alias("total"),
        ),
        lambda seen: seen["total"],
    )


def _short_runs(docs: DataFrame, length: int) -> DataFrame:
    """Every run of ``length`` words of the documents."""
    runs = docs.select(
        "doc_id",
        "text_hash",
        F.posexplode(_cut(F.col("text"))).alias("seg", "run"),
    )
    found = F.transform(
        steps(F.least(F.size("run") - (length - 1), F.lit(SEGMENT))),
        lambda i: F.struct(
            (F.col("seg").cast("bigint") * SEGMENT + i - 1).alias("start"),
            _span(F.col("run"), i, length).alias("span"),
        ),
    )
    return runs.select("doc_id", "text_hash", F.lit(length).alias("length"), F.explode(found).alias("w"))


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: how many of its words lie in spans of benchmark items.

    ``documents`` needs ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``; other
    columns are not read.  Returns ``doc_id, text_hash, n_words, n_hit, n_items, items_sha256,
    contaminated``.  A null or empty text has no words and no hits; a null id is a key like any
    other; repeated rows give repeated results; the same id with different texts gives a result
    per text.  Items that are null or hold no word match nothing; an item without an id counts
    for ``n_hit`` but not among the items; repeated items count once.  An empty benchmark leaves
    all documents clean.
    """
    spark = documents.sparkSession
    folder = workspace(spark)
    docs = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    windows = settle(_item_windows(benchmark), folder, "windows")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])

    segments = docs.select(
        "doc_id",
        "text_hash",
        F.explode(
            let(
                words(lower_ascii(F.col("text"))),
                lambda run: F.arrays_zip(
                    F.sequence(F.lit(0), F.size(_segments(run)) - 1).alias("seg"),
                    _segments(run).alias("run"),
                    F.array_repeat(F.size(run).cast("bigint"), F.size(_segments(run))).alias("n"),
                ),
            )
        ).alias("s"),
    )
    kept = settle(
        segments.select(
            "doc_id",
            "text_hash",
            "s.seg",
            F.col("s.n").alias("n_words"),
            F.array_distinct(_kept(F.col("s.run"))).alias("fps"),
        ),
        folder,
        "kept",
    )
    wanted = windows.where("fp is not null").select("fp").distinct()
    per_segment = (
        kept.select("doc_id", "text_hash", "seg", F.explode("fps").alias("fp"))
        .join(wanted, "fp")
        .groupBy("doc_id", "text_hash", "seg")
        .agg(F.collect_set("fp").alias("fps"))
    )
    matched = settle(
        per_segment.groupBy("doc_id", "text_hash").agg(
            F.map_from_entries(F.collect_list(F.struct("seg", "fps"))).alias("fps")
        ),
        folder,
        "matched",
    )

    # Only texts with a shared hash are split into words again.
    near = docs.alias("d").join(matched.alias("m"), same(docs, matched))
    near = near.select(
        docs["doc_id"],
        docs["text_hash"],
        matched["fps"],
        F.posexplode(_cut(docs["text"])).alias("seg", "run"),
    )
    near = near.select(
        "doc_id",
        "text_hash",
        "seg",
        "run",
        F.try_element_at("fps", F.col("seg")).alias("fps"),
    ).where("fps is not null")
    spans = near.select(
        "doc_id",
        "text_hash",
        F.lit(SPAN).alias("length"),
        F.explode(
            let(
                _kept(F.col("run")),
                lambda kept: F.transform(
                    F.filter(
                        steps(F.size(kept)),
                        lambda i: F.array_contains(F.col("fps"), kept[i - 1]),
                    ),
                    lambda i: F.struct(
                        (F.col("seg").cast("bigint") * SEGMENT + i - 1).alias("start"),
                        _span(F.col("run"), i, SPAN).alias("span"),
                    ),
                ),
            )
        ).alias("w"),
    )
    lengths = windows.where("fp is null").select("length").distinct().collect()
    for length in sorted(row["length"] for row in lengths):
        # Items shorter than a span: every run of their length is looked up.
        spans = spans.unionByName(_short_runs(docs, length))
    spans = spans.select("doc_id", "text_hash", "length", "w.start", "w.span")
    known = windows.select("length", "span").distinct()
    hits = settle(spans.join(known, ["length", "span"]), folder, "hits")

    words_hit = hits.groupBy("doc_id", "text_hash").agg(
        _covered(
            F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))
        ).alias("n_hit")
    )
    items = (
        hits.select("doc_id", "text_hash", "length", "span")
        .distinct()
        .join(windows.select("length", "span", "item"), ["length", "span"])
        .select("doc_id", "text_hash", "item")
        .distinct()
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    found = settle(
        words_hit.alias("a")
        .join(items.alias("b"), same(words_hit, items))
        .select(words_hit["doc_id"], words_hit["text_hash"], "n_hit", "items"),
        folder,
        "found",
    )
    counted = kept.where("seg = 0").select("doc_id", "text_hash", "n_words")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return counted.join(found, same(counted, found), "left").select(
        counted["doc_id"],
        counted["text_hash"],
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without the contaminated ones; all its columns and other rows stay."""
    id_name, text_name = unused(documents, "bad_id", "bad_hash")
    bad = settle(
        contamination(documents, benchmark)
        .where("contaminated")
        .select(F.col("doc_id").alias(id_name), F.col("text_hash").alias(text_name))
        .distinct(),
        workspace(documents.sparkSession),
        "bad",
    )
    return without(documents, bad)
