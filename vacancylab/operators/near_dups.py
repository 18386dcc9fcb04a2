"""Token-window near duplicates within employers.

Semantics (per employer, over its distinct texts in ``uniq_id`` order): a
posting p that is not yet flagged takes ``n`` windows of ``L`` tokens from its
text (E5); every later, unflagged posting q whose text contains *all* of p's
windows is flagged - unless at most one unflagged posting remains after p.

Plan:

1. Windows (E5) are JVM expressions: ``split`` on single spaces; long texts
   get ``n`` starts drawn from a seeded hash in ``n`` equal strata (pairwise
   more than ``L`` apart); short texts get three character slices.
2. Candidates without comparing pairs.  If q contains a window, q contains the
   window's inner tokens (all but the first and last, which may be cut) as
   whole tokens.  Every text is in a positional index of *winnowed* 4-gram
   fingerprints (the minimum hash in every run of ``W`` consecutive 4-grams,
   each with its place); all runs of all windows of p occur in q, so all their
   fingerprints are in q's list, at equal distances within a window.  p looks
   up the fingerprint of its windows that is rarest within the employer: texts
   that share a common introduction, but not the rest, do not meet.
3. A candidate must also hold the next-rarest fingerprints of p, those of the
   same window at their distance from the first; only then is a text read and
   verified with ``contains`` for every window.
4. The greedy pass is order dependent; it runs in rounds over (employer, key,
   id) tables, and only postings that are kept, or may have to be, look up
   candidates, so near copies never meet in pairs.

Disk: the postings are written once, compressed, and every step reads the texts
there.  What leaves a scan are fingerprints that pass a bit map of those that
some window holds; employers and ids are numbers in id order by then, so a row
of an index is a few bytes.  Texts are exchanged for verification only, those
of candidates and at most a part of them at a time.  A table that a later one
replaces is deleted, and so are a step's shuffle files (``Scratch``).

Sources whose windows all have fewer than ``W + 3`` inner tokens (texts under
about 20 tokens) probe an index of character grams instead: any containing
text holds all grams of their longest window, and the rarest one within the
employer is looked up.  A window of up to 32 characters is about one gram, so
texts that only share its common words do not meet.  A bit map of the grams in
question, of bounded size, keeps the others from leaving the scan.  Only a text
without characters looks up all later postings of its employer.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import Scratch, cut_lineage, land_table

K_GRAM = 4
WINNOW = 5
INNER = K_GRAM + WINNOW - 1          # inner tokens a probe needs
CHECKS = 4                           # further fingerprints a candidate must hold
ANYWHERE = -1000                     # place of a check of another window: before any text
GRAMS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32)   # characters of the grams of short texts
GRAM_WORDS = 16384                   # least 64-bit words of the bit map of each gram length
MAX_GRAM_WORDS = 1 << 20             # most of them: 8 MB
KEY_BITS = 32                        # bits of it for each key
FEW_ROWS = 200_000                   # rows whose numbers (8 bytes each) are broadcast to a scan of the texts
PART_ROWS = 1 << 16                  # texts that are exchanged at a time, ...
MAX_PARTS = 8                        # ... unless that takes more scans of the texts than this


# ------------------------------------------------------------------------ E5
def token_windows(text: Column, seed_key: Column, sequence_length: int = 10, n_sequences: int = 5,
                  seq_multiple: int = 5, seed: int = 42) -> Column:
    """E5: array of window strings for a text.

    Long texts (at least ``n * L * multiple`` tokens): ``n`` windows of ``L``
    tokens joined by single spaces, starts pairwise more than ``L`` apart.
    Short texts: three character slices cut at round-half-even(tokens / 3).
    """
    L, n = sequence_length, n_sequences
    if (n * L * seq_multiple - L) // n <= L + 1:
        raise ValueError("windows of the shortest long text would overlap: raise seq_multiple")
    tokens = F.split(text, " ", -1)
    size = F.size(tokens)
    stratum = F.floor((size - L) / n).cast("int")
    span = stratum - L - 1
    def drawn(i: int) -> Column:
        digest = F.md5(F.concat(seed_key.cast("string"), F.lit(f"|{seed}|{i}")))
        return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), span).cast("int")
    starts = [F.lit(i) * stratum + drawn(i) for i in range(n)]
    long_w = F.array(*[F.array_join(F.slice(tokens, s + 1, L), " ") for s in starts])
    cut = F.bround(size / 3.0, 0).cast("int")
    short_w = F.array(F.substr(text, F.lit(1), cut), F.substr(text, cut + 1, cut), F.substr(text, 2 * cut + 1))
    return F.when(size >= F.lit(n * L * seq_multiple), long_w).otherwise(short_w)


# ------------------------------------------------------------------------ fingerprints
# Shingling runs in Arrow UDFs with numpy: a run of characters is hashed by the
# difference of two prefix sums, so neither grams of tokens nor grams of
# characters loop in Python, and only one text at a time becomes a Python string.
# Both sides (index and probes) hash the characters of the k-gram joined by
# single spaces (tokens hold no spaces, so the join is injective).

_POWERS: list = []


def _powers(size: int):
    """Powers of an odd base and of its inverse (mod 2^64), kept for the longest text so far."""
    import numpy as np
    if not _POWERS or len(_POWERS[0]) < size:
        base, room = 0x9E3779B97F4A7C15, max(4096, 2 * size)
        _POWERS[:] = [np.cumprod(np.full(room, b, dtype=np.uint64)) for b in (base, pow(base, -1, 2**64))]
    return _POWERS[0][:size], _POWERS[1][:size]


def _prefix_sums(text: str):
    """(characters, sums of char * base^place before each place, what divides a place out)."""
    import numpy as np
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    up, down = _powers(len(chars))
    return chars, np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(chars * up, dtype=np.uint64)]), down


def _mixed(h):
    """Spread over all bits, else the low ones depend on few characters."""
    import numpy as np
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def _kgram_hashes(text: str):
    """A 64-bit hash of every run of ``K_GRAM`` tokens (``split(" ")``)."""
    import numpy as np
    chars, sums, down = _prefix_sums(text)
    spaces = np.flatnonzero(chars == 32)
    n = len(spaces) + 2 - K_GRAM
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    begin, end = np.concatenate([[0], spaces + 1])[:n], np.concatenate([spaces, [len(chars)]])[K_GRAM - 1:]
    return _mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def _winnow(h):
    """Places of the fingerprints: wherever a hash is the least of some run of
    ``WINNOW``.  Ties count all, so a run has the same places in every text."""
    import numpy as np
    if len(h) < WINNOW:
        return np.empty(0, dtype=np.int64)
    if len(h) == WINNOW:
        return np.flatnonzero(h == h.min())
    from numpy.lib.stride_tricks import sliding_window_view
    least = sliding_window_view(h, WINNOW).min(axis=1)
    # the greatest of the minima of the runs that hold a place equals its hash where it is one of them
    padded = np.concatenate([np.full(WINNOW - 1, least[0]), least, np.full(WINNOW - 1, least[-1])])
    return np.flatnonzero(sliding_window_view(padded, WINNOW).max(axis=1) == h)


def _lists(rows: list[tuple], **types: str):
    """Arrow array of one list per row; a row is one numpy array per field of the list's structs."""
    import numpy as np
    offsets = np.cumsum([0, *(len(r[0]) for r in rows)], dtype=np.int32)
    fields = [pa.array(np.concatenate([np.empty(0, dtype=t), *(r[i] for r in rows)]).astype(t)) for i, t in enumerate(types.values())]
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, [*types]))


def _salted(h, salt: int):
    """Keys of one employer, so that a bit map of them tells employers apart."""
    import numpy as np
    return _mixed(h.view(np.uint64) ^ np.uint64(salt & 0xFFFFFFFFFFFFFFFF))


def _salt() -> Column:
    return F.xxhash64("company_name")


def _window_prints(windows: list, salt: int) -> tuple:
    """Fingerprints of all windows' inner tokens: any text that contains window
    ``w`` has them, at one distance from ``pos``.  Windows with fewer than
    ``INNER`` inner tokens have none."""
    import numpy as np
    inner = [window.split(" ")[1:-1] for window in windows]
    # one hashing pass over all windows; the runs that cross from one into the next are left out
    every = _kgram_hashes(" ".join(token for tokens in inner for token in tokens))
    begins = np.cumsum([0, *map(len, inner)])
    hashes = [every[b:b + max(0, len(tokens) + 1 - K_GRAM)] for b, tokens in zip(begins, inner, strict=False)]
    at = [_winnow(h) for h in hashes]
    nowhere = np.empty(0, dtype=np.int64)
    return (_salted(np.concatenate([nowhere, *(h[i] for h, i in zip(hashes, at, strict=True))]), salt),
            np.repeat(np.arange(len(at)), [len(i) for i in at]), np.concatenate([nowhere, *at]))


def _gram_hashes(text: str, lengths) -> dict:
    """For each length a 64-bit hash of every run of so many characters."""
    import numpy as np
    chars, sums, down = _prefix_sums(text)
    return {n: _mixed((sums[n:] - sums[:-n]) * down[:len(chars) - n + 1] + np.uint64(n)) for n in lengths if n <= len(chars)}


def _window_grams(windows: list) -> tuple:
    """Grams of the longest window, of the greatest listed length that fits into it."""
    import numpy as np
    longest = max(windows, key=len, default="")
    n = max((g for g in GRAMS if g <= len(longest)), default=0)
    keys = np.unique(_gram_hashes(longest, [n])[n]) if n else np.empty(0, dtype=np.int64)
    return keys, np.full(len(keys), n)


def _keys(**types: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(name, t) for name, t in types.items()]))


@F.arrow_udf(T.StructType([T.StructField("prints", _keys(key=T.LongType(), w=T.IntegerType(), pos=T.IntegerType())),
                           T.StructField("grams", _keys(key=T.LongType(), n=T.IntegerType()))]))
def window_keys(windows: pa.Array, salts: pa.Array) -> pa.Array:
    """What finds the texts that contain all windows: their fingerprints or, where they have none, their grams."""
    prints, grams = [], []
    for ws, salt in zip(windows, salts.to_pylist(), strict=True):
        ws = ws.as_py() or []
        prints.append(_window_prints(ws, salt))
        grams.append(_window_grams([] if len(prints[-1][0]) else ws))
    return pa.StructArray.from_arrays([_lists(prints, key="int64", w="int32", pos="int32"),
                                       _lists(grams, key="int64", n="int32")], ["prints", "grams"])


def _bit_map(keys: DataFrame, count: int):
    """Bit map of ``count`` keys, as the driver reads it: two bits of ``KEY_BITS``
    for each key, so that few others pass however many keys there are, up to
    ``MAX_GRAM_WORDS`` words; from there on more of them pass."""
    import numpy as np
    size = 1 << (min(MAX_GRAM_WORDS, max(GRAM_WORDS, count * KEY_BITS // 64)) - 1).bit_length()
    mask = F.lit(64 * size - 1).cast("long")
    bit = F.explode(F.array(F.col("key").bitwiseAND(mask), F.shiftrightunsigned("key", 32).bitwiseAND(mask)))
    words = keys.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits")).toArrow()
    out = np.zeros(size, dtype=np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def _held(words, h):
    """Which of the hashes may be in the bit map."""
    import numpy as np
    found = np.ones(len(h), dtype=bool)
    for part in (h, (h >> 32) & 0xFFFFFFFF):
        found &= ((words[(part >> 6) & (len(words) - 1)] >> (part & 63)) & 1) == 1
    return found


def print_finder(keys: DataFrame):
    """Arrow UDF: (text, salt) -> its winnowed 4-gram fingerprints that may be
    in ``keys`` (key), with their places (none of NULL)."""
    words = _bit_map(keys, keys.count())

    @F.arrow_udf(_keys(key=T.LongType(), pos=T.IntegerType()))
    def find(texts: pa.Array, salts: pa.Array) -> pa.Array:
        out = []
        for t, salt in zip(texts, salts.to_pylist(), strict=True):
            h = _kgram_hashes(t.as_py() or "")
            at = _winnow(h)
            h = _salted(h[at], salt)
            kept = _held(words, h)
            out.append((h[kept], at[kept]))
        return _lists(out, key="int64", pos="int32")

    return find


def gram_finder(keys: DataFrame):
    """Arrow UDF: text -> its distinct grams that may be in ``keys`` (key, n).

    The driver reads a bit map per length, never the keys; the join behind it
    drops what passes besides them."""
    import numpy as np
    maps = {r["n"]: _bit_map(keys.where(F.col("n") == r["n"]), r["count"]) for r in keys.groupBy("n").count().collect()}

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def find(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            found = [np.empty(0, dtype=np.int64)]
            for n, h in _gram_hashes(t.as_py() or "", maps).items():
                found.append(np.unique(h[_held(maps[n], h)]))
            out.append((np.concatenate(found),))
        lists = _lists(out, key="int64")
        return pa.ListArray.from_arrays(lists.offsets, lists.values.field(0))

    return find


# ------------------------------------------------------------------------ E4


def distinct_employer_texts(postings: DataFrame) -> DataFrame:
    """First posting (smallest id) per (employer, text); NULL texts and NULL
    employers do not take part.  Columns: company_name, uniq_id, job_description."""
    rows = postings.filter(F.col("company_name").isNotNull() & F.col("job_description").isNotNull())
    # one shuffle; the map-side partial aggregate already drops repeated texts
    firsts = (rows.groupBy("company_name", F.unhex(F.sha2("job_description", 256)).alias("__h"))
              .agg(F.min_by(F.struct("uniq_id", "job_description"), F.col("uniq_id")).alias("r")))
    return firsts.select("company_name", "r.uniq_id", "r.job_description")


def _rarest(probes: DataFrame, index: DataFrame) -> DataFrame:
    """Per source the key that fewest texts of its employer hold (with window
    and place), and the next ones as ``checks``.  A source has at most as many
    keys as its windows have tokens."""
    df = index.groupBy("company_name", "key").agg(F.count(F.lit(1)).alias("df"))
    ranked = probes.join(df, ["company_name", "key"]).groupBy("company_name", "src").agg(
        F.sort_array(F.collect_list(F.struct("df", "key", "w", "pos"))).alias("r"))
    return ranked.select("company_name", "src", F.element_at("r", 1).alias("f"),
                         F.slice("r", 2, CHECKS).alias("checks")).select(
        "company_name", "src", "f.key", "f.w", "f.pos", "checks")


def _keeper(scratch: Scratch | None):
    """How a step's table is written once, and how it goes when nothing reads it any more."""
    return (scratch.land, scratch.drop) if scratch else (cut_lineage, lambda *_: None)


def probe_tables(docs: DataFrame, windows: DataFrame, scratch: Scratch | None = None,
                 numbered=lambda rows: rows) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(probes, index, marks): what each source looks up (company_name, src, key,
    w, pos, checks), the places of these keys in the texts (company_name, dst,
    key, at), and those of the checks.  A text that contains all windows of a
    source has the source's key in the index and its checks in the marks.

    Keys are 4-gram fingerprints, hashes of character grams for sources too
    short for those, and one common key for sources without a character; the
    latter two have no place and no checks.  ``numbered`` replaces the
    company_name and uniq_id of rows that have left the scan of the texts.
    """
    land, drop = _keeper(scratch)
    own = land(numbered(windows.select("company_name", "uniq_id", window_keys(F.col("windows"), _salt()).alias("k")))
               .select("company_name", F.col("uniq_id").alias("src"), "k.prints", "k.grams"))
    held = own.select("company_name", "src", F.explode("prints").alias("f")).select("company_name", "src", "f.*")
    short = own.where(F.size("prints") == 0).join(held.select("company_name", "src").distinct(), ["company_name", "src"], "left_anti")
    held_grams = land(short.select("company_name", "src", F.explode("grams").alias("f")).select("company_name", "src", "f.*"))
    # of all the texts' keys only those leave the scan that some window holds, as far as the bit maps tell
    found = land(numbered(docs.select("company_name", "uniq_id",
                                      print_finder(held)(F.col("job_description"), _salt()).alias("prints"),
                                      gram_finder(held_grams)(F.col("job_description")).alias("grams")))
                 .withColumnRenamed("uniq_id", "dst"))
    prints = found.select("company_name", "dst", F.explode("prints").alias("f")).select(
        "company_name", "dst", "f.key", F.col("f.pos").alias("at"))
    by_print = land(_rarest(held, prints))
    nowhere = F.lit(None).cast("int")
    short_grams = held_grams.select("company_name", "src", "key", nowhere.alias("w"), nowhere.alias("pos"))
    # the bit map chooses; a join by employer would put a whole employer's texts into one task
    grams = land(found.select("company_name", "dst", F.explode("grams").alias("key"))
                 .join(short_grams.select("company_name", "key").distinct(), ["company_name", "key"], "left_semi")
                 .select("company_name", "dst", "key", nowhere.alias("at")))
    unchecked = F.slice("checks", 1, 0).alias("checks")
    by_gram = land(_rarest(short_grams, grams).select("company_name", "src", "key", "w", "pos", unchecked))
    bare = short.join(by_gram, ["company_name", "src"], "left_anti").select(
        "company_name", "src", F.lit(0).cast("long").alias("key"), nowhere.alias("w"), nowhere.alias("pos"))
    bare = bare.withColumn("checks", F.array().cast(by_print.schema["checks"].dataType))
    every = land(by_print.unionByName(by_gram).unionByName(bare))
    everywhere = numbered(docs.select("company_name", "uniq_id")).join(
        bare.select("company_name").distinct(), "company_name", "left_semi").select(
        "company_name", F.col("uniq_id").alias("dst"), F.lit(0).cast("long").alias("key"), nowhere.alias("at"))
    # a text before all sources of a key is no target, and a source after all texts of its key has none
    first = every.groupBy("company_name", "key").agg(F.min("src").alias("first"))
    index = land(prints.unionByName(grams).unionByName(everywhere).join(first, ["company_name", "key"])
                 .where("dst > first").drop("first"))
    last = index.groupBy("company_name", "key").agg(F.max("dst").alias("last"))
    probes = land(every.join(last, ["company_name", "key"]).where("last > src")
                  .select("company_name", "src", "key", "w", "pos", "checks"))
    checked = probes.select("company_name", F.explode("checks").alias("c")).select("company_name", "c.key").distinct()
    marks = land(prints.join(checked, ["company_name", "key"], "left_semi"))
    drop(own, found, by_print, held_grams, grams, by_gram, every)
    return probes, index, marks


def candidate_pairs(sources: DataFrame, targets: DataFrame, marks: DataFrame) -> DataFrame:
    """(company_name, src, dst): later texts that hold a source's rarest key and
    all its checks, those of the same window at the same distance."""
    met = sources.join(targets, ["company_name", "key"]).where("dst > src").select(
        "company_name", "src", "dst", "w", "pos", "at", "checks")
    sure = met.where(F.size("checks") == 0).select("company_name", "src", "dst")
    asked = met.where(F.size("checks") > 0).select(
        "company_name", "src", "dst", "at", F.col("w").alias("w0"), F.col("pos").alias("pos0"),
        F.size("checks").alias("wanted"), F.posexplode("checks").alias("nth", "c")).select(
        "*", F.col("c.key").alias("key"))
    # joined on the place itself, so a text that repeats a token does not meet itself place by place
    there = F.when(F.col("c.w") == F.col("w0"), F.col("at") + F.col("c.pos") - F.col("pos0")).otherwise(ANYWHERE)
    places = marks.select("company_name", "dst", "key", F.explode(F.array("at", F.lit(ANYWHERE))).alias("there")).distinct()
    held = asked.withColumn("there", there).join(places, ["company_name", "dst", "key", "there"])
    passed = held.groupBy("company_name", "src", "dst", "at", "wanted").agg(
        F.count_distinct("nth").alias("n")).where("n = wanted").select("company_name", "src", "dst")
    return sure.unionByName(passed).distinct()


def verified_edges(pairs: DataFrame, docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Edges (company_name, src, dst): the candidates whose later text contains every window."""
    return (pairs
            .join(windows.select("company_name", F.col("uniq_id").alias("src"), "windows"), ["company_name", "src"])
            .join(docs.select("company_name", F.col("uniq_id").alias("dst"), "job_description"), ["company_name", "dst"])
            .where(F.forall("windows", lambda w: F.col("job_description").contains(w)))
            .select("company_name", "src", "dst"))


def _settle(state: DataFrame, edges: DataFrame, blocked: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Decide what the edges made so far decide: a posting with an edge out of
    a kept one is flagged; one that is not blocked and whose edges all come
    from flagged ones is kept.  One join and aggregate per round."""
    land, drop = _keeper(scratch)
    state = state.join(blocked.withColumn("blocked", F.lit(True)), ["company_name", "id"], "left")
    state = land(state.fillna(False, ["blocked"]))
    left = state.where("st = 0").count()
    while left:
        votes = (edges.join(state.select("company_name", F.col("id").alias("src"), F.col("st").alias("by")),
                            ["company_name", "src"])
                 .groupBy("company_name", F.col("dst").alias("id"))
                 .agg(F.bool_or(F.col("by") == 1).alias("hit"), F.bool_or(F.col("by") == 0).alias("waits")))
        was, state = state, land(state.join(votes, ["company_name", "id"], "left").select(
            "company_name", "id", "done", "blocked",
            F.when(F.col("st") != 0, F.col("st"))
            .when(F.col("hit"), F.lit(2))
            .when(~F.col("blocked") & ~F.coalesce("waits", F.lit(False)), F.lit(1))
            .otherwise(F.lit(0)).alias("st")))
        drop(was)
        before, left = left, state.where("st = 0").count()
        if left == before:
            break
    return state


def greedy_rounds(docs: DataFrame | None, windows: DataFrame | None, probes: DataFrame, index: DataFrame,
                  marks: DataFrame, scratch: Scratch | None = None, verify=None) -> tuple[DataFrame, DataFrame]:
    """The greedy pass in rounds that make edges where they are needed.

    A posting is blocked while an earlier, unflagged source of one of its keys
    has not looked up its targets.  Each round lets the unblocked sources look
    up the undecided postings; from the second round on also the first 1, 4,
    16, ... waiting sources of every key, so that lists of texts that share a
    key without containing each other take a logarithmic number of rounds.  A
    group of near copies falls to its first posting and makes one edge per
    posting.  Returns the state (company_name, id, st with 1 kept, 2 flagged)
    of the postings in the probes or the index - the others are kept - and the
    edges made.  ``verify`` makes edges of candidate pairs; without it ``docs``
    and ``windows`` do."""
    land, drop = _keeper(scratch)
    verify = verify or (lambda pairs: verified_edges(pairs, docs, windows))
    asked = index.select("company_name", F.col("dst").alias("id")).distinct()
    asking = probes.select("company_name", F.col("src").alias("id")).distinct()
    state = land(asked.withColumn("st", F.lit(0)).unionByName(
        asking.join(asked, ["company_name", "id"], "left_anti").withColumn("st", F.lit(1)))
        .withColumn("done", F.lit(False)))
    edges = state.select("company_name", F.col("id").alias("src"), F.col("id").alias("dst")).limit(0)
    ahead = 0
    while not state.where("st = 0").isEmpty():
        targets = land(index.join(state.where("st = 0").select("company_name", F.col("id").alias("dst")),
                                  ["company_name", "dst"], "left_semi"))

        def waiting(state: DataFrame) -> DataFrame:
            return probes.join(state.where("not done and st != 2").select("company_name", F.col("id").alias("src")),
                               ["company_name", "src"], "left_semi")

        def blocked(state: DataFrame, targets: DataFrame = targets) -> DataFrame:
            first = waiting(state).groupBy("company_name", "key").agg(F.min("src").alias("first"))
            return targets.join(first, ["company_name", "key"]).where("first < dst").select(
                "company_name", F.col("dst").alias("id")).distinct()

        turn = waiting(state).join(blocked(state).withColumnRenamed("id", "src"), ["company_name", "src"], "left_anti")
        if ahead:
            order = Window.partitionBy("company_name", "key").orderBy("src")
            turn = turn.unionByName(waiting(state).withColumn("nth", F.row_number().over(order))
                                    .where(F.col("nth") <= ahead).drop("nth")).distinct()
        turn = land(turn)
        was, edges = edges, land(edges.unionByName(verify(candidate_pairs(turn, targets, marks))))
        drop(was)
        looked = turn.select("company_name", F.col("src").alias("id"), F.lit(True).alias("now"))
        was, state = state, land(state.join(looked, ["company_name", "id"], "left").select(
            "company_name", "id", "st", (F.col("done") | F.coalesce("now", F.lit(False))).alias("done")))
        drop(was)
        was, settled = state, _settle(state, edges, blocked(state), scratch)
        drop(was, turn, targets)
        state = settled.drop("blocked")
        ahead = max(1, 4 * ahead)
    return state, edges


def landed_rows(postings: DataFrame, land) -> DataFrame:
    """The postings of some employer, written once: (row, company_name, uniq_id,
    text_key, job_description), where ``row`` numbers them."""
    from .evaluation import text_hash
    rows = postings.filter(F.col("company_name").isNotNull())
    return land(rows.select(F.monotonically_increasing_id().alias("row"), "company_name", "uniq_id",
                            text_hash(F.col("job_description")).alias("text_key"), "job_description"), "zstd")


def numbered_ids(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(names, ids): the ids of ``distinct_employer_texts`` with a number in
    their order (company_name, uniq_id, number), and for each row that it takes
    the number of its employer, the least of its ids, and its own
    (company_name, uniq_id, row)."""
    firsts = rows.groupBy("company_name", "text_key").agg(F.min(F.struct("uniq_id", "row")).alias("r")).select(
        "company_name", "r.*")
    named = scratch.land(firsts.groupBy("company_name", "uniq_id").agg(F.collect_list("row").alias("rows"))
                         .repartitionByRange("company_name", "uniq_id").sortWithinPartitions("company_name", "uniq_id")
                         .withColumn("number", F.monotonically_increasing_id()))
    employers = named.groupBy("company_name").agg(F.min("number").alias("employer"))
    ids = scratch.land(named.join(employers, "company_name").select(
        F.col("employer").alias("company_name"), F.col("number").alias("uniq_id"), F.explode("rows").alias("row")))
    return named.drop("rows"), ids


def _of_rows(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the ``wanted`` rows (row), before any exchange if these are few."""
    wanted = wanted.select("row").distinct()
    return texts.join(F.broadcast(wanted), "row", "left_semi") if wanted.count() <= FEW_ROWS else texts


def _verifier(texts: DataFrame, windows: DataFrame, ids: DataFrame, scratch: Scratch):
    """Edges of candidate pairs from the landed ``texts`` (row, job_description),
    a part of the later texts at a time."""
    rows = ids.select("company_name", F.col("uniq_id").alias("dst"), "row")

    def verify(pairs: DataFrame) -> DataFrame:
        asked = scratch.land(pairs.join(rows, ["company_name", "dst"]))
        parts = max(1, min(MAX_PARTS, -(-asked.select("row").distinct().count() // PART_ROWS)))
        edges = []
        for part in range(parts):
            mine = F.pmod(F.xxhash64("row"), F.lit(parts)) == part
            some = asked.where(mine)
            docs = _of_rows(texts.where(mine), some).join(rows, "row").withColumnRenamed("dst", "uniq_id")
            edges.append(scratch.land(verified_edges(some.select("company_name", "src", "dst"), docs, windows)))
        made = edges[0]
        for more in edges[1:]:
            made = made.unionByName(more)
        return made

    return verify


def _flagged(rows: DataFrame, scratch: Scratch, n_sequences: int, sequence_length: int, seq_multiple: int, seed: int,
             skip_last_pair: bool) -> DataFrame:
    """E4 on landed rows; reads tables of ``scratch``."""
    # a posting without an id neither flags nor is flagged, since it is not before or after any
    rows = rows.where("text_key IS NOT NULL AND uniq_id IS NOT NULL")
    names, ids = numbered_ids(rows, scratch)
    docs = rows.select("company_name", F.col("row").alias("uniq_id"), "job_description")
    cut = token_windows(F.col("job_description"), F.col("uniq_id"), sequence_length, n_sequences, seq_multiple, seed)
    windows = rows.select("company_name", F.col("row").alias("uniq_id"), cut.alias("windows"))

    def numbered(some: DataFrame) -> DataFrame:
        return some.drop("company_name").withColumnRenamed("uniq_id", "row").join(ids, "row").drop("row")

    probes, index, marks = probe_tables(docs, windows, scratch, numbered)
    asking = ids.join(probes.select("company_name", F.col("src").alias("uniq_id")).distinct(), ["company_name", "uniq_id"], "left_semi")
    windows = scratch.land(_of_rows(windows.withColumnRenamed("uniq_id", "row"), asking).drop("company_name")
                           .join(asking, "row").drop("row"), "zstd")
    verify = _verifier(docs.select(F.col("uniq_id").alias("row"), "job_description"), windows, ids, scratch)
    state, edges = greedy_rounds(None, None, probes, index, marks, scratch, verify)
    flagged = state.where("st = 2").select("company_name", F.col("id").alias("uniq_id"))
    if skip_last_pair:
        kept = state.where("st = 1").select("company_name", F.col("id").alias("src"))
        last = ids.join(flagged, ["company_name", "uniq_id"], "left_anti").groupBy("company_name").agg(
            F.max("uniq_id").alias("last_kept"))
        earliest = edges.join(kept, ["company_name", "src"], "left_semi").groupBy("company_name", "dst").agg(
            F.min("src").alias("by"))
        by_last = scratch.land(earliest.join(last, "company_name").where(F.col("by") == F.col("last_kept")))
        # an earlier kept source may have had its turn after the posting was flagged
        sources = probes.join(kept.join(by_last.select("company_name", F.col("by").alias("src")), ["company_name", "src"],
                                        "left_anti"), ["company_name", "src"], "left_semi")
        targets = index.join(by_last, ["company_name", "dst"], "left_semi")
        earlier = verify(candidate_pairs(sources, targets, marks))
        back = (by_last.join(earlier, ["company_name", "dst"], "left_anti").groupBy("company_name")
                .agg(F.count("*").alias("n"), F.min("dst").alias("uniq_id")).where("n = 1"))
        flagged = flagged.join(back, ["company_name", "uniq_id"], "left_anti")
    return names.join(flagged.select(F.col("uniq_id").alias("number")), "number", "left_semi").select("company_name", "uniq_id")


def token_duplicates(postings: DataFrame, n_sequences: int = 3, sequence_length: int = 10,
                     seq_multiple: int = 5, seed: int = 42, skip_last_pair: bool = True) -> DataFrame:
    """Flagged near-duplicate postings (company_name, uniq_id).

    The order-dependent pass runs in distributed rounds for every employer,
    whatever its size.  ``skip_last_pair`` is its rule that a posting flags
    nothing when at most one unflagged posting follows: that concerns only the
    last kept posting, and only if exactly one posting was flagged by it
    first, so that one is taken back."""
    with Scratch(postings.sparkSession, "near-dups") as scratch:
        rows = landed_rows(postings, scratch.land)
        return land_table(_flagged(rows, scratch, n_sequences, sequence_length, seq_multiple, seed, skip_last_pair), "flagged")


# ------------------------------------------------------------------------ E6
def combined_duplicates(postings: DataFrame, token_flags: DataFrame, text_key: Column | None = None) -> DataFrame:
    """E6 per employer: n_postings, non_identical_postings, exact_duplicates,
    token_based_duplicates, unique_postings, unique_share, n_duplicates.
    ``text_key`` is what equal texts share, by default their hash."""
    from .evaluation import text_hash
    rows = postings.filter(F.col("company_name").isNotNull())
    base = rows.groupBy("company_name").agg(
        F.count(F.lit(1)).alias("n_postings"),
        F.countDistinct(text_hash(F.col("job_description")) if text_key is None else text_key).alias("non_identical_postings"))
    tok = token_flags.groupBy("company_name").agg(F.count(F.lit(1)).alias("token_based_duplicates"))
    out = base.join(tok, "company_name", "left").fillna(0, ["token_based_duplicates"])
    return (out.withColumn("exact_duplicates", F.col("n_postings") - F.col("non_identical_postings"))
            .withColumn("unique_postings", F.col("non_identical_postings") - F.col("token_based_duplicates"))
            .withColumn("unique_share", F.col("unique_postings") / F.col("n_postings"))
            .withColumn("n_duplicates", F.col("exact_duplicates") + F.col("token_based_duplicates")))


def token_and_exact_duplicates(postings: DataFrame, n_sequences: int = 3, sequence_length: int = 10,
                               seq_multiple: int = 5, seed: int = 42, skip_last_pair: bool = True) -> DataFrame:
    """``combined_duplicates`` with the flags of ``token_duplicates``, from one reading of the postings."""
    with Scratch(postings.sparkSession, "near-dups") as scratch:
        rows = landed_rows(postings, scratch.land)
        flags = _flagged(rows, scratch, n_sequences, sequence_length, seq_multiple, seed, skip_last_pair)
        return land_table(combined_duplicates(rows, flags, F.col("text_key")), "combined")


def combined_summary(per_employer: DataFrame) -> DataFrame:
    """E6 summary: duplicates (all / exact / token) and their percentages,
    share of token duplicates among all, employers with duplicates, means."""
    from .evaluation import round_half_up
    tot = F.sum("n_postings")
    return per_employer.agg(
        F.sum("n_duplicates").cast("bigint").alias("n_duplicates"),
        F.sum("exact_duplicates").cast("bigint").alias("n_exact_duplicates"),
        F.sum("token_based_duplicates").cast("bigint").alias("n_token_duplicates"),
        tot.cast("bigint").alias("n_total"),
        round_half_up(100.0 * F.sum("n_duplicates") / tot, 2).alias("duplicate_pct"),
        round_half_up(100.0 * F.sum("exact_duplicates") / tot, 2).alias("exact_pct"),
        round_half_up(100.0 * F.sum("token_based_duplicates") / tot, 2).alias("token_pct"),
        round_half_up(100.0 * F.sum("token_based_duplicates") / F.sum("n_duplicates"), 2).alias("token_share_pct"),
        round_half_up(100.0 * F.count(F.when(F.col("n_duplicates") > 0, 1)) / F.count(F.lit(1)), 2)
        .alias("employers_with_duplicates_pct"),
        round_half_up(F.avg("n_duplicates"), 1).alias("mean_duplicates"),
        round_half_up(100.0 * F.avg("unique_share"), 2).alias("mean_unique_share_pct"))
