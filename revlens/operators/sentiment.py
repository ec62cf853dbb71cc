"""Rule-based sentiment of short texts: a fold over the tokens of each row.

The rules are those published by Hutto and Gilbert ("VADER", ICWSM 2014): a
lexicon of valences, degree words before a word, negation within three words,
"but", capitals and marks. Everything is evaluated inside the JVM:

* a row's tokens are looked up and folded once, with a fixed-size state (the last
  three words' weights and flags, running sums), so the work is linear in the
  length of the text;
* a lexicon of up to ``INLINE_LEXICON_MAX`` words lies in the plan as one literal,
  an array of small maps indexed by a hash of the word: no shuffle, and a lookup
  does not grow with the lexicon;
* a larger one is joined by token; the same fold follows.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions import text as X
from revlens.operators.joins import broadcast_if_small
from revlens.sources.io import persist_cut

# A selection of everyday words with the valences, from -4 to 4, that
# the published lexicon of the rules above gives them (C. J. Hutto, MIT licence).
# It is quoted without the file at hand; the whole file is read by read_lexicon.
LEXICON = {
    "good": 1.9, "great": 3.1, "excellent": 2.7, "amazing": 2.8, "awesome": 3.1,
    "best": 3.2, "better": 1.9, "love": 3.2, "loved": 2.9, "like": 1.5, "liked": 1.8,
    "nice": 1.8, "happy": 2.7, "friendly": 2.2, "delicious": 2.7, "tasty": 2.0,
    "fresh": 1.3, "clean": 1.7, "perfect": 2.7, "wonderful": 2.7, "fantastic": 2.6,
    "enjoy": 2.2, "enjoyed": 2.3, "recommend": 1.5, "fast": 0.8, "fine": 0.8,
    "pleasant": 2.3, "helpful": 1.8, "worth": 0.9, "fun": 2.3, "kind": 2.4,
    "bad": -2.5, "worse": -2.1, "worst": -3.1, "terrible": -2.1, "awful": -2.0,
    "horrible": -2.5, "hate": -2.7, "hated": -3.2, "poor": -2.1, "rude": -2.0,
    "dirty": -1.9, "slow": -1.0, "cold": -0.5, "bland": -1.1, "disappointing": -2.2,
    "disappointed": -1.9, "expensive": -0.9, "overpriced": -1.6, "wrong": -2.1,
    "sad": -2.1, "angry": -2.3, "sick": -1.9, "gross": -2.1, "boring": -1.3,
    "problem": -1.7, "mess": -1.5, "waste": -1.8, "noisy": -0.9, "unfriendly": -2.0,
}
# Words that turn a word within the next three. Any word that holds
# "n't" does so too, and so do these auxiliaries with "nt" written together.
NEGATORS = ["not", "no", "nor", "never", "none", "nothing", "nobody", "nowhere", "neither", "cannot",
            "without", "rarely", "seldom", "despite"]
AUXILIARIES = ["ai", "are", "ca", "could", "did", "does", "do", "had", "has", "have", "is", "might", "must",
               "need", "ought", "sha", "should", "was", "were", "wo", "would"]
# Degree words that strengthen, and that weaken, a word after them.
STRONGER = ["absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly", "deeply",
            "enormously", "entirely", "especially", "exceptionally", "extremely", "fully", "greatly", "highly",
            "hugely", "incredibly", "intensely", "more", "most", "particularly", "purely", "quite", "really",
            "remarkably", "so", "substantially", "thoroughly", "totally", "tremendously", "unbelievably",
            "unusually", "utterly", "very"]
WEAKER = ["almost", "barely", "hardly", "less", "little", "marginally", "occasionally", "partly", "scarcely",
          "slightly", "somewhat"]
# Fixed values of the rules: weight of a degree word and its decay with distance,
# of capitals, of a negation, of "never so" at two distances, of what stands before
# and after "but"; weight and number of exclamation marks; of question marks; the
# constant of the compound score.
DEGREE, DECAY = 0.293, (1.0, 0.95, 0.9)
CAPITALS = 0.733
NEGATION = -0.74
NEVER_SO = (1.5, 1.25)
BUT = (0.5, 1.5)
EXCLAMATION, EXCLAMATIONS = 0.292, 4
QUESTION, QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96
ALPHA = 15.0
#: Lexicons up to this size lie in the plan; larger ones are joined.
INLINE_LEXICON_MAX = 20_000

#: Flags of a word.
NEGATES, NEVER, SO, LEAST, AT, IS_BUT = 1, 2, 4, 8, 16, 32


def rule_words() -> dict[str, tuple[float, int]]:
    """Degree weight and flags of every word that the rules name."""
    out: dict[str, list] = {}

    def of(word):
        return out.setdefault(word, [0.0, 0])
    for w in STRONGER:
        of(w)[0] = DEGREE
    for w in WEAKER:
        of(w)[0] = -DEGREE
    for words, flag in ((NEGATORS + [a + "nt" for a in AUXILIARIES], NEGATES), (["never"], NEVER),
                        (["so", "this"], SO), (["least"], LEAST), (["at", "very"], AT), (["but"], IS_BUT)):
        for w in words:
            of(w)[1] |= flag
    return {w: (b, k) for w, (b, k) in out.items()}


def read_lexicon(spark, path: str) -> DataFrame:
    """(token, valence) of a lexicon file in the published form: tab-separated, a
    token and its mean valence first, further columns ignored, no header. Lines
    without a number are left out."""
    t = spark.read.csv(path, sep="\t", quote="", schema="token string, valence string")
    return t.select("token", F.expr("try_cast(valence AS DOUBLE)").alias("valence")).where(
        "token IS NOT NULL AND valence IS NOT NULL")


def rated_lexicon(reviews: DataFrame, text_col: str = "Review", stars_col: str = "ReviewStars",
                  middle: float = 3.0, least: int = 5, smooth: float = 1.0) -> DataFrame:
    """(token, valence, high, low): a lexicon learnt from rated texts.

    ``high`` and ``low`` count the reviews above, and at or below, ``middle``
    stars that hold the token; tokens of fewer than ``least`` reviews are left
    out. The valence is the logarithm of the ratio of the two smoothed shares, cut
    to [-4, 4] and rounded to two digits; tokens of valence 0 say nothing and are
    left out. Counts combine map-side; a review counts once for a token. Null
    texts and stars are not used."""
    r = reviews.where(F.col(text_col).isNotNull() & F.col(stars_col).isNotNull()).select(
        (F.col(stars_col) > middle).cast("long").alias("up"),
        F.array_distinct(tokens(X.ascii_lower(F.col(text_col)))).alias("t"))
    all_ = r.agg(F.sum("up").alias("h"), F.sum(1 - F.col("up")).alias("l"))
    g = r.select("up", F.explode("t").alias("token")).groupBy("token").agg(
        F.sum("up").alias("high"), F.sum(1 - F.col("up")).alias("low")).where(F.col("high") + F.col("low") >= least)
    share = [(F.col(c) + smooth) / (n + 2 * smooth) for c, n in
             (("high", all_.select("h").scalar()), ("low", all_.select("l").scalar()))]
    v = F.round(F.least(F.greatest(F.log(share[0] / share[1]), F.lit(-4.0)), F.lit(4.0)), 2)
    return g.select("token", v.alias("valence"), "high", "low").where("valence <> 0")


def tokens(text: Column) -> Column:
    """Pieces between blanks, of two characters or more, without the punctuation
    around them; a piece of which two characters or fewer would remain (an
    emoticon) stays as it is."""
    def strip(t):
        bare = F.btrim(t, F.lit(X.PUNCTUATION))
        return F.when(F.length(bare) <= 2, t).otherwise(bare)
    return F.transform(F.filter(F.split(text, X.BLANKS), lambda t: F.length(t) > 1), strip)


def _literal(table: dict[str, object], kind: str):
    """Lookup in a dict that lies in the plan: ``find(token)``, null if absent. An
    array of small maps, one literal; crc32 tells the place."""
    n = max(1, len(table) // 2)
    rows: list[dict] = [{} for _ in range(n)]
    for w, v in table.items():
        rows[zlib.crc32(w.encode()) % n][w] = v
    maps = F.from_json(F.lit(json.dumps(rows)), f"array<map<string,{kind}>>")
    return lambda t: F.try_element_at(F.get(maps, (F.crc32(t) % n).cast("int")), t)


def _token_table(spark, lexicon) -> DataFrame:
    """(token, valence), one row per token: the largest valence where a token
    is listed twice; null tokens and valences are left out."""
    if isinstance(lexicon, dict):
        lexicon = spark.createDataFrame(sorted(lexicon.items()), "token string, valence double")
    lex = lexicon.select("token", "valence").where("token IS NOT NULL AND valence IS NOT NULL")
    return lex.groupBy("token").agg(F.max(F.col("valence").cast("double")).alias("valence"))


def sentiment(df: DataFrame, text_col: str = "text_ascii", lexicon=None,
              inline_max: int = INLINE_LEXICON_MAX) -> DataFrame:
    """Negative, Neutral and Positive share and Compound score of each row (K3).

    Each lexicon word has its valence, strengthened or weakened by degree words
    among the three words before (less with distance) and by capitals where only
    some words have them; a weakened word keeps its direction. A negation among
    these three, or a "least" that is not "at least" or "very least", turns it;
    "never so" and "never this" strengthen. Words before the first "but" count
    half, those after it one and a half times. Exclamation and question marks add
    to the prevailing direction. A degree word, and "kind" before "of", has no
    valence of its own; a lexicon word before another works neither as degree word
    nor as negation. Compound is s / sqrt(s^2 + 15) of the sum s, to four digits;
    the shares, to three digits, weigh each word of a direction by its valence
    plus one, every other word by one. Text without words: all zero. Null text: all
    null. Every row is scored by itself, whatever its key; other columns stay.

    ``lexicon``: dict, or DataFrame (token, valence; lower case). Up to
    ``inline_max`` tokens it lies in the plan, beyond it is joined.
    """
    lexicon = LEXICON if lexicon is None else lexicon
    if not isinstance(lexicon, dict):
        # Written: it is counted here and may be joined, which must not learn it twice.
        lexicon = persist_cut(_token_table(df.sparkSession, lexicon), df.sparkSession, "lexicon")
        few = lexicon.limit(inline_max + 1).collect()
        lexicon = {r["token"]: r["valence"] for r in few} if len(few) <= inline_max else lexicon
    keep = [c for c in df.columns if c != text_col]
    if isinstance(lexicon, dict) and len(lexicon) <= inline_max:
        find = _literal(lexicon, "double")
        t = df.select(*keep, F.col(text_col).alias("_x"), tokens(F.col(text_col)).alias("_t"))
        t = t.select(*keep, "_x", F.zip_with("_t", F.array_repeat(_mixed(F.col("_t")), F.size("_t")),
                                             lambda w, mixed: _word(w, find(F.lower(w)), mixed)).alias("_w"))
    else:
        t = _joined(df, text_col, keep, lexicon)
    return _scores(t.select(*keep, "_x", _next_of(F.col("_w")).alias("_f")), keep)


def _capital(w: Column) -> Column:
    return (w == F.upper(w)) & (w != F.lower(w))


def _mixed(words: Column) -> Column:
    """Some words, but not all, are written in capitals."""
    return F.exists(words, _capital) & F.exists(words, lambda w: ~_capital(w))


def _word(w: Column, valence: Column, mixed: Column) -> Column:
    """What the fold needs of a word: valence (null if none), degree weight, flags."""
    low = F.lower(w)
    rule = _literal({k: {"b": b, "k": f} for k, (b, f) in rule_words().items()}, "struct<b:double,k:int>")(low)
    loud = F.when(mixed & _capital(w), F.lit(CAPITALS)).otherwise(0.0)
    b = F.coalesce(rule["b"], F.lit(0.0))
    k = F.coalesce(rule["k"], F.lit(0)).bitwiseOR(F.when(F.contains(low, F.lit("n't")), NEGATES).otherwise(0))
    plain = valence.isNull()
    return F.struct(
        F.when(b == 0, valence + F.signum(valence) * loud).alias("v"),
        F.when(plain & (b != 0), b + loud).otherwise(0.0).alias("b"),
        F.when(plain, k).otherwise(0).cast("int").alias("k"),
        (low == "kind").alias("kind"), (low == "of").alias("of"))


def _has(flags: Column, flag: int) -> Column:
    return flags.bitwiseAND(F.lit(flag)) != 0


def _next_of(words: Column) -> Column:
    """Fold over the words of a row. The state holds weights (b) and flags (k) of
    the last three words, the score s of the last one, which is added when the
    next word is known (it may be "of" after "kind"), and the sums so far."""
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("s", "pos", "neg", "b1", "b2", "b3")],
                    *[F.lit(0).alias(c) for c in ("n", "n_pos", "n_neg", "k1", "k2", "k3")],
                    F.lit(False).alias("but"), F.lit(False).alias("kind"))

    def step(a: Column, x: Column) -> Column:
        k1, k2, k3 = a["k1"], a["k2"], a["k3"]
        turn = F.lit(NEGATION)
        c1 = F.when(_has(k1, NEGATES), turn).otherwise(1.0)
        c2 = F.when(_has(k2, NEVER) & _has(k1, SO), NEVER_SO[0]).when(_has(k2, NEGATES), turn).otherwise(1.0)
        c3 = (F.when(_has(k3, NEVER) & (_has(k2, SO) | _has(k1, SO)), NEVER_SO[1])
              .when(_has(k3, NEGATES), turn).otherwise(1.0))
        c4 = F.when(_has(k1, LEAST) & ~_has(k2, AT), turn).otherwise(1.0)
        m = F.abs(x["v"])
        for b, decay, c in ((a["b1"], DECAY[0], c1), (a["b2"], DECAY[1], c2), (a["b3"], DECAY[2], c3)):
            m = F.greatest(m + b * decay, F.lit(0.0)) * F.abs(c)
        sign = F.signum(x["v"]) * F.signum(c1) * F.signum(c2) * F.signum(c3) * F.signum(c4)
        s = F.when(a["but"], BUT[1]).otherwise(1.0) * sign * m * F.abs(c4)
        but = ~a["but"] & _has(x["k"], IS_BUT)
        return F.struct(*_added(a, ~(a["kind"] & x["of"]), F.when(but, BUT[0]).otherwise(1.0), s),
                        x["b"].alias("b1"), a["b1"].alias("b2"), a["b2"].alias("b3"),
                        (a["n"] + 1).alias("n"), *_counted(a, ~(a["kind"] & x["of"])),
                        x["k"].alias("k1"), k1.alias("k2"), k2.alias("k3"),
                        (a["but"] | but).alias("but"), x["kind"].alias("kind"))

    return F.aggregate(words, zero, step)


def _added(a: Column, counts: Column, half: Column, s: Column) -> list[Column]:
    """The last score joins the sums, and ``s`` takes its place."""
    last = F.when(counts, a["s"]).otherwise(0.0)
    return [F.coalesce(s, F.lit(0.0)).alias("s"), ((a["pos"] + F.greatest(last, F.lit(0.0))) * half).alias("pos"),
            ((a["neg"] + F.least(last, F.lit(0.0))) * half).alias("neg")]


def _counted(a: Column, counts: Column) -> list[Column]:
    return [(a["n_pos"] + (counts & (a["s"] > 0)).cast("int")).alias("n_pos"),
            (a["n_neg"] + (counts & (a["s"] < 0)).cast("int")).alias("n_neg")]


def _marks(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _scores(t: DataFrame, keep: list[str]) -> DataFrame:
    f, x = F.col("_f"), F.col("_x")
    q = _marks(x, "?")
    loud = (F.least(_marks(x, "!"), F.lit(EXCLAMATIONS)) * F.lit(EXCLAMATION)
            + F.when(q > QUESTIONS, MANY_QUESTIONS).when(q > 1, q * F.lit(QUESTION)).otherwise(0.0))
    s = t.select(*keep, f["n"].alias("_n"), loud.alias("_loud"),
                 (f["pos"] + F.greatest(f["s"], F.lit(0.0))).alias("_p"),
                 (-f["neg"] - F.least(f["s"], F.lit(0.0))).alias("_g"),
                 (f["n_pos"] + (f["s"] > 0).cast("int")).alias("_np"),
                 (f["n_neg"] + (f["s"] < 0).cast("int")).alias("_ng"))
    sums = s.select(*keep, "_n", (F.col("_p") - F.col("_g") + F.signum(F.col("_p") - F.col("_g")) * F.col("_loud")).alias("_s"),
                    (F.col("_p") + F.col("_np") + F.when(F.col("_p") + F.col("_np") > F.col("_g") + F.col("_ng"),
                                                         F.col("_loud")).otherwise(0.0)).alias("_pos"),
                    (F.col("_g") + F.col("_ng") + F.when(F.col("_p") + F.col("_np") < F.col("_g") + F.col("_ng"),
                                                         F.col("_loud")).otherwise(0.0)).alias("_neg"),
                    (F.col("_n") - F.col("_np") - F.col("_ng")).cast("double").alias("_neu"))
    total = F.col("_pos") + F.col("_neg") + F.col("_neu")
    zero = F.lit(0.0)

    def share(c):
        return F.when(F.col("_n") == 0, zero).otherwise(F.round(F.col(c) / total, 3))
    return sums.select(*keep, share("_neg").alias("Negative"), share("_neu").alias("Neutral"),
                       share("_pos").alias("Positive"),
                       F.when(F.col("_n") == 0, zero).otherwise(
                           F.round(F.col("_s") / F.sqrt(F.col("_s") * F.col("_s") + F.lit(ALPHA)), 4)).alias("Compound"))


def _joined(df: DataFrame, text_col: str, keep: list[str], lexicon) -> DataFrame:
    """Rows with their words (see :func:`_word`), valences by a join with a lexicon
    too large for the plan. Rows get an id of their own in a written table, which
    holds their words as well; of the exploded words only row, place and valence are
    shuffled, and the valences come back in text order."""
    spark = df.sparkSession
    if isinstance(lexicon, dict):
        lexicon = persist_cut(_token_table(spark, lexicon), spark, "lexicon")
    rows = df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_t", tokens(F.col(text_col)))
    rows = persist_cut(rows.withColumn("_mixed", _mixed(F.col("_t"))), spark, "sentiment-rows")
    t = rows.select("_row", F.posexplode("_t").alias("_at", "_w")).select(
        "_row", "_at", F.lower("_w").alias("token"))
    t = t.join(broadcast_if_small(lexicon), "token", "left").select("_row", "_at", "valence")
    found = t.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_at", "valence"))).alias("_o"))
    back = rows.join(found, "_row", "left")
    none = F.expr("CAST(array() AS array<struct<_at:int,valence:double>>)")
    return back.select(*keep, F.col(text_col).alias("_x"), F.zip_with(
        "_t", F.coalesce("_o", none), lambda w, o: _word(w, o["valence"], F.col("_mixed"))).alias("_w"))
