"""Text queries with an exact SQL counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rotativa.functions import text as text_functions
from rotativa.operators import text_features
from rotativa.operators.clean import classifier_rows
from rotativa.plans import classification
from rotativa.queries.base import CLEAN, WORDS, query, table
from rotativa.queries.rows import headlines


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned headlines with their link as key."""
    return classifier_rows(headlines(spark, folder), "enlace")


@query("clean_text", f"WITH {CLEAN} SELECT enlace, label, clean_text FROM clean")
def clean_text(spark, folder):
    return texts(spark, folder)


@query(
    "clean_text_keep_empty",
    f"""
    WITH {CLEAN}
    SELECT enlace, label, CASE WHEN length(titular) % 5 = 0 THEN '' ELSE clean_text END AS clean_text
    FROM cleaned JOIN headlines USING (enlace) WHERE label IS NOT NULL AND clean_text IS NOT NULL
    """,
)
def clean_text_keep_empty(spark, folder):
    """Every fifth title is a number, of which cleaning leaves nothing; such rows stay here."""
    rows = headlines(spark, folder)
    titles = F.when(F.char_length("titular") % 5 == 0, "2024").otherwise(F.col("titular"))
    return classifier_rows(rows.withColumn("titular", titles), "enlace", drop_empty=False)


@query(
    "clean_text_collapsed",
    r"""
    SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^a-záéíóúñ\s]', '', 'g'), '\s+', ' ', 'g')) AS clean_text
    FROM documents
    """,
)
def clean_text_collapsed(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", text_functions.clean_text_collapsed(F.col("text")).alias("clean_text")
    )


@query(
    "label_distribution",
    f"WITH {CLEAN} SELECT label, count(*) AS n FROM clean GROUP BY label ORDER BY n DESC, label LIMIT 20",
)
def label_distribution(spark, folder):
    return classification.label_distribution(texts(spark, folder))


@query("token_counts", f"WITH {WORDS} SELECT word, count(*) AS n FROM words GROUP BY word")
def token_counts(spark, folder):
    return text_features.word_counts(text_features.with_words(texts(spark, folder)))


# --- fixed values: Spark's default English stop words --------------------------
STOP_WORDS = """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
    it its itself they them their theirs themselves what which who whom this that these those am is are was were be
    been being have has had having do does did doing a an the and but if or because as until while of at by for with
    about against between into through during before after above below to from up down in out on off over under
    again further then once here there when where why how all any both each few more most other some such no nor not
    only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
    he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
    weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot
    could here's how's let's ought that's there's what's when's where's who's why's would
""".split()

STOPPED = (
    WORDS
    + f""",
stopped AS (
    SELECT enlace, word FROM words WHERE word NOT IN ({", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS)})
)"""
)


@query("stopword_filter", f"WITH {STOPPED} SELECT word, count(*) AS n FROM stopped GROUP BY word")
def stopword_filter(spark, folder):
    words = text_features.without_stop_words(text_features.with_words(texts(spark, folder)))
    return text_features.word_counts(words, "filtered_words")


@query(
    "tfidf_terms",
    f"""
    WITH {WORDS},
    tf AS (SELECT enlace, word AS term, count(*) AS tf FROM words GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
    SELECT enlace, term, tf, df, round(tf * ln(((SELECT count(*) FROM clean) + 1) / (df + 1)), 6) AS tfidf
    FROM tf JOIN df USING (term)
    """,
)
def tfidf_terms(spark, folder):
    words = text_features.with_words(classification.dealt(texts(spark, folder)))
    return text_features.tfidf_terms(words, "enlace")


@query(
    "label_index",
    f"""
    WITH {CLEAN}, counts AS (SELECT label, count(*) AS n FROM clean GROUP BY label)
    SELECT label, n, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS label_index FROM counts
    """,
)
def label_index(spark, folder):
    return text_features.label_index(texts(spark, folder))
