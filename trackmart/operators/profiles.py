"""Artist profiles: prompts out, replies in, stored profiles merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmart import schemas as S
from trackmart.functions import name_key
from trackmart.functions.joins import salted_left_join
from trackmart.operators.artists import PROFILE_FIELDS

# --------------------------------------------------------------------------
# The figures a prompt lists, and the reply's fields (fixed values).
# --------------------------------------------------------------------------
PROMPT_FIGURES = [
    ("main genre", "genre_group", ""),
    ("mean popularity", "avg_popularity", " of 100"),
    ("highest popularity", "peak_popularity", " of 100"),
    ("tracks", "track_count", ""),
    ("mean danceability", "avg_danceability", " of 1"),
    ("mean energy", "avg_energy", " of 1"),
    ("mean valence", "avg_valence", " of 1"),
    ("mean acousticness", "avg_acousticness", " of 1"),
    ("mean tempo", "avg_tempo", " beats a minute"),
    ("mean speechiness", "avg_speechiness", " of 1"),
    ("mean instrumentalness", "avg_instrumentalness", " of 1"),
]
REPLY_TEXT_FIELDS = {
    "origin_country": "Unknown",
    "style_description": "",
    "fun_fact": "",
    "audio_analysis": "",
    "career_insight": "",
    "signature_sound": "",
}
REPLY_KEYS = [
    "origin_country",
    "career_start",
    "style_description",
    "fun_fact",
    "audio_analysis",
    "career_insight",
    "similar_artists",
    "signature_sound",
]

# What a prompt asks for under each key.
REPLY_FORMS = {
    "origin_country": "a country",
    "career_start": "a year, as a number",
    "style_description": "two sentences",
    "fun_fact": "one sentence",
    "audio_analysis": "two sentences on the figures",
    "career_insight": "two sentences",
    "similar_artists": "a list of three names",
    "signature_sound": "a few words",
}

_TAGGED_FENCE = "```json"
_FENCE = "```"
_BLANKS = r"^\s+|\s+$"
_MARK = "end of reply"


def profile_prompts(overview: DataFrame) -> DataFrame:
    """One prompt per artist from its primary statistics and top tracks.

    Takes the output of :func:`trackmart.operators.artists.artist_overview`.
    """
    figures = [
        F.concat(F.lit(f"- {label}: "), F.col(column).cast("string"), F.lit(unit))
        for label, column, unit in PROMPT_FIGURES
    ]
    years = F.format_string("- years with tracks: %d to %d", "first_year", "last_year")
    titles = F.array_join(F.transform("top_tracks", lambda t: t["track_name"]), ", ")
    prompt = F.concat_ws(
        "\n",
        F.concat(F.lit("Write a profile of the music artist "), "artist_name", F.lit(".")),
        F.lit("Measured figures:"),
        *figures,
        years,
        F.concat(F.lit("Most popular titles: "), titles),
        F.lit("Answer with one JSON object with these keys:"),
        *[F.lit(f"- {key}: {REPLY_FORMS[key]}") for key in REPLY_KEYS],
    )
    return overview.select("artist_name", prompt.alias("prompt"))


def reply_body(reply: Column) -> Column:
    """JSON text of a reply: a json-tagged fence, else any fence, else everything.

    An unclosed fence runs to the end of the text.
    """

    def after(marker: str) -> Column:
        start = F.locate(marker, reply) + len(marker)
        return F.substring_index(F.substring(reply, start, F.length(reply)), _FENCE, 1)

    body = (
        F.when(reply.contains(_TAGGED_FENCE), after(_TAGGED_FENCE))
        .when(reply.contains(_FENCE), after(_FENCE))
        .otherwise(reply)
    )
    return F.regexp_replace(body, _BLANKS, "")


def reply_document(reply: Column) -> Column:
    """The reply's JSON object and a mark behind it, null where the text is not JSON.

    The parser ignores text after a complete value. Closing an array behind the body
    makes such text an error, and anything else that ends it early misses the mark.
    """
    marked = F.concat(F.lit("["), reply_body(reply), F.lit(f',{{"{_MARK}":true}}]'))
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    return F.from_json(marked, "array<map<string,variant>>", strict)


def parse_replies(replies: DataFrame, stats: DataFrame) -> DataFrame:
    """Profile rows from raw replies, with ``parsed`` false and a ``reason`` for unusable ones.

    ``replies`` holds artist_name, reply, generated_at; ``stats`` one row per
    artist key (:func:`trackmart.operators.artists.primary_genre`), giving the
    canonical name and the default career start. A default replaces a missing
    key only: an explicit JSON null stays null. Of a repeated key the last one counts.
    Unusable are replies for an artist without tracks, that are not one JSON object, or
    that give a career start that is no number.
    """
    read = replies.select(
        name_key().alias("artist_key"),
        F.col("artist_name").alias("_requested"),
        "reply",
        "generated_at",
        reply_document(F.col("reply")).alias("_doc"),
    )
    known = stats.select("artist_key", F.col("artist_name").alias("_canonical"), "first_year")
    joined = salted_left_join(read, known, "artist_key", spread=["reply", "generated_at"])
    entries = F.map_entries(F.get("_doc", F.lit(0)))

    def given(name: str) -> Column:
        return F.filter(entries, lambda e: e["key"] == name)

    def value(name: str, kind: str) -> Column:
        last = F.try_element_at(given(name), F.lit(-1))
        return F.try_variant_get(last["value"], "$", kind)

    def field(name: str, found: Column, default: Column) -> Column:
        return F.when(F.size(given(name)) > 0, found).otherwise(default)

    columns = {
        name: field(name, value(name, "string"), F.lit(default))
        for name, default in REPLY_TEXT_FIELDS.items()
    }
    year = F.round(value("career_start", "double")).try_cast("int")
    columns["career_start"] = field("career_start", year, F.col("first_year"))
    similar = F.to_json(value("similar_artists", "variant"))
    columns["similar_artists"] = field("similar_artists", similar, F.lit("[]"))

    marked = F.map_contains_key(F.get("_doc", F.lit(1)), _MARK)
    one_object = (F.size("_doc") == 2) & F.get("_doc", F.lit(0)).isNotNull() & marked
    no_number = value("career_start", "string").isNotNull() & year.isNull()
    reason = (
        F.when(F.col("_canonical").isNull(), "unknown artist")
        .when(~F.coalesce(one_object, F.lit(False)), "not one JSON object")
        .when(no_number, "career start is no number")
    )
    return (
        joined.withColumn("reason", reason)
        .withColumn("parsed", F.col("reason").isNull())
        .select(
            F.coalesce("_canonical", "_requested").alias("artist_name"),
            *[
                F.when(F.col("parsed"), columns[c]).alias(c) if c in columns else F.col(c)
                for c in PROFILE_FIELDS
            ],
            "parsed",
            "reason",
            "reply",
        )
    )


def accepted(parsed: DataFrame) -> DataFrame:
    """Rows ready for the profile table."""
    return parsed.filter("parsed").select(*S.ARTIST_PROFILES.fieldNames())


def quarantine(parsed: DataFrame) -> DataFrame:
    """Unusable replies, kept with their text and the reason for inspection."""
    return parsed.filter(~F.col("parsed")).select("artist_name", "reason", "reply", "generated_at")


def profile_upsert(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored profiles with incoming ones laid over them, by artist name.

    An incoming row replaces every column of a stored one; among several
    incoming rows of a name the latest wins, then the greatest by its texts.
    One shuffle: both inputs are ranked together per key.
    """
    texts = [c for c in PROFILE_FIELDS if c != "generated_at"]
    window = Window.partitionBy("artist_name").orderBy(
        F.desc("_incoming"), F.desc("generated_at"), *[F.desc(c) for c in texts]
    )
    both = stored.withColumn("_incoming", F.lit(0)).unionByName(
        incoming.withColumn("_incoming", F.lit(1))
    )
    ranked = both.withColumn("_rank", F.row_number().over(window))
    return ranked.filter("_rank = 1").drop("_rank", "_incoming")


def similar_artist_links(profiles: DataFrame, stats: DataFrame) -> DataFrame:
    """One row per suggested similar artist, with its statistics where known.

    ``stats`` has one row per artist key. A name that very many profiles suggest
    is spread over tasks by the suggesting artist.
    """
    names = F.from_json("similar_artists", "array<string>")
    links = profiles.select("artist_name", F.explode(names).alias("similar_artist"))
    target = stats.select(
        "artist_key",
        F.col("artist_name").alias("matched_artist"),
        F.col("genre_group").alias("matched_genre"),
        F.col("avg_popularity").alias("matched_popularity"),
    )
    keyed = links.withColumn("artist_key", name_key("similar_artist"))
    return salted_left_join(keyed, target, "artist_key", spread=["artist_name"]).drop("artist_key")


def encode_similar(df: DataFrame, column: str = "similar_artists") -> DataFrame:
    """Array of names to the stored JSON text; a null list becomes ``[]``."""
    empty = F.array().cast("array<string>")
    return df.withColumn(column, F.to_json(F.coalesce(column, empty)))


def decode_similar(df: DataFrame, column: str = "similar_artists") -> DataFrame:
    """Stored JSON text back to an array of names."""
    return df.withColumn(column, F.from_json(column, "array<string>"))
