"""Climate text signals from call transcripts.

Per transcript (a call of firm i in quarter q) with B bigrams in total, for a
topic bigram set C:
    exposure  = (1/B) * sum over bigrams b of 1[b in C]
    risk      = (1/B) * sum 1[b in C] * 1[b's sentence has a risk word]
    positive  = (1/B) * sum 1[b in C] * 1[b's sentence has a positive word]
    negative  = (1/B) * sum 1[b in C] * 1[b's sentence has a negative word]
    sentiment = (1/B) * sum 1[b in C] * T(b),  T = +1 positive, -1 negative, else 0
(a sentence with both tones counts as positive for T); the firm-year value is
the mean of the quarterly values.

Tokenisation (fixed): the text of a call is its turns in order, joined by a
line feed; sentences split on ``[.!?\\n]+``, tokens are runs of Unicode letters of
the lower-cased text, bigrams are consecutive tokens of the whole call.  A bigram
whose tokens lie in two sentences (or turns) belongs to the sentence of its first.

Execution: a call is never assembled.  Every token is a row with the bigram that it
begins; tokens meet the tone words in one join and bigrams the topic sets in another, broadcast where
the dictionary is small, whatever its length never as literals.  A partially aggregated ``groupBy`` folds the
rows of a sentence to its tones and hits, a second one sums the sentences of a call.
The bigrams between turns come from one slim row per turn (first token, last token) and
are hits of the last sentence of their turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sizing import broadcast_if_small

SENTENCE_SPLIT = r"[.!?\n]+"
TOKEN = r"\p{L}+"

# ---------------------------------------------------------------- DEFAULT LISTS
# The source names the topic sets and tone dictionaries but ships none.  These
# defaults are picked from frequent tokens/bigrams of the driver's invented
# multilingual prose so that every signal is exercised; real use passes the
# real lists.  Topic sets are disjoint.
DEFAULT_TOPICS = {
    "cc": ("the of", "of the", "de la", "der die"),
    "op": ("and the", "to the", "la de", "die der"),
    "rg": ("the and", "for the", "in the", "der und"),
    "ph": ("the the", "de de", "der der", "that the"),
}
DEFAULT_RISK_WORDS = ("is", "es", "ou", "von")
DEFAULT_POSITIVE_WORDS = ("with", "for", "que", "und")
DEFAULT_NEGATIVE_WORDS = ("was", "by", "en", "den")
# ------------------------------------------------------------ END DEFAULT LISTS

KINDS = ("expo", "risk", "pos", "neg", "sent")


TURNS_PER_BLOCK = 4096  # turns of one call that one window task orders together
FLAGS = ("is_risk", "is_pos", "is_neg")


def _sentence_tokens(turns: DataFrame, key_cols, text_col: str) -> DataFrame:
    """(key, turn, body, behind, token, bigram): every token of every sentence with the bigram that it begins within its
    turn; ``behind`` counts the sentences behind it, ``body`` is the digest of the turn's text.  A turn without
    tokens gives one row without any."""
    sentences = F.filter(F.transform(F.split(F.lower(F.col(text_col)), SENTENCE_SPLIT, -1),
                                     lambda s: F.regexp_extract_all(s, F.lit(TOKEN), 0)), lambda t: F.size(t) > 0)
    turn = turns.select(*key_cols, "_turn", "_body", sentences.alias("s"))
    sent = turn.select(*key_cols, "_turn", "_body", F.size("s").alias("n"), "s", F.posexplode_outer("s").alias("i", "t"))
    # the token that follows the sentence in its turn closes its last bigram
    closed = F.when(F.col("i") + 1 < F.col("n"), F.concat("t", F.slice(F.element_at("s", F.col("i") + 2), 1, 1))) \
              .otherwise(F.col("t"))
    sent = sent.select(*key_cols, "_turn", "_body", (F.col("n") - 1 - F.col("i")).alias("_behind"), "t", closed.alias("c"))
    sent = sent.select(*key_cols, "_turn", "_body", "_behind", "c", F.posexplode_outer("t").alias("k", "token"))
    bigram = F.when(F.col("k") + 1 < F.size("c"), F.concat("token", F.lit(" "), F.element_at("c", F.col("k") + 2)))
    return sent.select(*key_cols, "_turn", "_body", "_behind", "token", bigram.alias("bigram"))


def _crossing_bigrams(turns: DataFrame, key_cols, text_col: str) -> DataFrame:
    """Bigrams from the last token of a turn to the first of the next turn that has one; they belong to the turn's
    last sentence.

    Turns are ordered in blocks of ``TURNS_PER_BLOCK`` turn numbers, then the blocks of a
    call among themselves, so a call that holds much of the table is spread over many tasks.
    Rows of equal turn number are ordered by their tokens; a NULL turn number comes first."""
    low = F.lower(F.col(text_col))
    last_token = F.reverse(F.regexp_extract(F.reverse(low), TOKEN, 0))
    ends = turns.select(*key_cols, "_turn", "_body", F.regexp_extract(low, TOKEN, 0).alias("_first"),
                        last_token.alias("_last")).filter(F.col("_first") != F.lit(""))
    ends = ends.withColumn("_block", F.floor(F.col("_turn") / TURNS_PER_BLOCK))
    inside = Window.partitionBy(*key_cols, "_block").orderBy("_turn", "_first", "_last", "_body")
    ends = ends.select("*", F.lead("_first").over(inside).alias("_next"),
                       F.first("_first").over(inside).alias("_head"))
    blocks = Window.partitionBy(*key_cols).orderBy("_block")
    last = ends.filter(F.col("_next").isNull()).withColumn("_next", F.lead("_head").over(blocks))
    both = ends.filter(F.col("_next").isNotNull()).unionByName(last.filter(F.col("_next").isNotNull()))
    return both.select(*key_cols, "_turn", "_body", F.lit(0).alias("_behind"), F.lit(None).cast("string").alias("token"),
                       F.concat("_last", F.lit(" "), "_next").alias("bigram"))


def _dictionary(spark, topics: dict, max_broadcast_rows: int) -> DataFrame:
    """One row per topic bigram with a 0/1 column per topic; it is an argument of the
    caller, so its size is known without a job."""
    rows = [(b, *[int(b in ws) for ws in topics.values()]) for b in sorted({b for ws in topics.values() for b in ws})]
    schema = ", ".join(["bigram string"] + [f"hits_{t} int" for t in topics])
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= max_broadcast_rows else df


def tone_table(spark, risk=DEFAULT_RISK_WORDS, positive=DEFAULT_POSITIVE_WORDS, negative=DEFAULT_NEGATIVE_WORDS) -> DataFrame:
    """(token, is_risk, is_pos, is_neg) of three word lists."""
    lists = [frozenset(x) for x in (risk, positive, negative)]
    rows = [(w, *[w in ws for ws in lists]) for w in sorted(frozenset().union(*lists))]
    return spark.createDataFrame(rows, ", ".join(["token string"] + [f"{f} boolean" for f in FLAGS]))


def transcript_signals(turns: DataFrame, key_cols, text_col: str = "text", topics=None, turn_col: str = "turn",
                       max_broadcast_rows: int = 5_000_000, tone_words: DataFrame | None = None,
                       keep: list | None = None, **words) -> DataFrame:
    """Signals per transcript (key_cols identify a transcript, turn_col orders its turns).

    ``topics``: topic -> bigrams; ``risk_words``, ``pos_words``, ``neg_words``: the tone lists, or ``tone_words``: all
    of them as (token, is_risk, is_pos, is_neg), one row per token, which is persisted, measured and added to ``keep``.
    A transcript without bigrams gets NULL signals."""
    spark = turns.sparkSession
    topics = {t: frozenset(ws) for t, ws in (topics or DEFAULT_TOPICS).items()}
    if tone_words is not None:
        tones = broadcast_if_small(tone_words.select("token", *FLAGS), max_broadcast_rows, keep)
    else:  # arguments of the caller: their number is known
        lists = [words.get(k, d) for k, d in (("risk_words", DEFAULT_RISK_WORDS), ("pos_words", DEFAULT_POSITIVE_WORDS),
                                              ("neg_words", DEFAULT_NEGATIVE_WORDS))]
        tones = tone_table(spark, *lists)
        tones = F.broadcast(tones) if sum(map(len, lists)) <= max_broadcast_rows else tones
    turns = turns.select(*key_cols, F.col(turn_col).alias("_turn"), F.col(text_col),
                         F.xxhash64(F.col(text_col)).alias("_body"))
    rows = _sentence_tokens(turns, key_cols, text_col).join(tones, "token", "left").unionByName(
        _crossing_bigrams(turns, key_cols, text_col), allowMissingColumns=True)
    rows = rows.join(_dictionary(spark, topics, max_broadcast_rows), "bigram", "left")
    # equal sentences of equal turns fold into one row, with the sum of their bigrams
    sentences = rows.groupBy(*key_cols, "_turn", "_body", "_behind").agg(
        F.count("bigram").alias("n"), *[F.sum(f"hits_{t}").alias(f"hits_{t}") for t in topics],
        *[F.coalesce(F.bool_or(f), F.lit(False)).alias(f) for f in FLAGS])
    tone = F.when(F.col("is_pos"), 1).when(F.col("is_neg"), -1).otherwise(0)
    aggs = [F.sum("n").alias("n_bigrams")]
    for topic in topics:
        h = F.coalesce(F.col(f"hits_{topic}"), F.lit(0))
        aggs += [F.sum(h).alias(f"{topic}_expo"),
                 F.sum(F.when(F.col("is_risk"), h).otherwise(0)).alias(f"{topic}_risk"),
                 F.sum(F.when(F.col("is_pos"), h).otherwise(0)).alias(f"{topic}_pos"),
                 F.sum(F.when(F.col("is_neg"), h).otherwise(0)).alias(f"{topic}_neg"),
                 F.sum(h * tone).alias(f"{topic}_sent")]
    sums = sentences.groupBy(*key_cols).agg(*aggs)
    b = F.col("n_bigrams").cast("double")
    out = [F.try_divide(F.col(f"{t}_{k}").cast("double"), b).alias(f"{t}_{k}_ew")
           for t in topics for k in KINDS]
    return sums.select(*key_cols, "n_bigrams", *out)


def large_tone_lists(texts: DataFrame, size: int = 5_000, text_col: str = "text") -> DataFrame:
    """Tone lists of ``size`` words each from the words of ``texts``: those with the least digest of a list's letter and
    the word.  A stand-in, drawn by rule, for dictionaries of real length."""
    words = texts.select(F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(TOKEN), 0)).alias("token")).distinct()
    out = None
    for flag, letter in zip(FLAGS, "rpn"):
        own = words.orderBy(F.md5(F.concat(F.lit(letter), "token")), "token").limit(size)
        own = own.select("token", *[F.lit(f == flag).alias(f) for f in FLAGS])
        out = own if out is None else out.union(own)
    return out.groupBy("token").agg(*[F.bool_or(f).alias(f) for f in FLAGS])


def firm_year_signals(transcripts: DataFrame, firm_col: str = "firm_id", year_col: str = "year",
                      quarter_col: str = "quarter", topics=None) -> DataFrame:
    """Mean over the quarters of a firm-year of the quarterly values (several
    calls in one quarter are averaged first)."""
    topics = topics or DEFAULT_TOPICS
    sig = [f"{t}_{k}_ew" for t in topics for k in KINDS]
    q = transcripts.groupBy(firm_col, year_col, quarter_col).agg(*[F.avg(c).alias(c) for c in sig])
    return q.groupBy(firm_col, year_col).agg(*[F.avg(c).alias(c) for c in sig])


def conversation_transcripts(conversations: DataFrame) -> DataFrame:
    """Driver ``conversations`` as call transcripts: one transcript per conv_id,
    firm = conv_id % 20, year = 2019 + conv_id % 3, quarter = 1 + conv_id % 4.
    Turns stay separate rows."""
    return conversations.select(
        "conv_id", "turn", "text",
        (F.col("conv_id") % 20).alias("firm_id"),
        (F.lit(2019) + F.col("conv_id") % 3).cast("int").alias("year"),
        (F.lit(1) + F.col("conv_id") % 4).cast("int").alias("quarter"))


def text_signals(conversations: DataFrame, topics=None, **words) -> DataFrame:
    """Firm-year signals from the conversations table."""
    tr = conversation_transcripts(conversations)
    per_call = transcript_signals(tr, ["conv_id", "firm_id", "year", "quarter"], "text", topics, **words)
    return firm_year_signals(per_call, topics=topics)
