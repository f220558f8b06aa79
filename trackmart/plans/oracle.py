"""The same results in plain SQL, for a second engine to compute.

Each statement starts from the shared derivation of the sample catalogue and
states the operator's meaning anew; nothing here is used by the library.
"""

from __future__ import annotations

from trackmart.plans.sample_splits import SPLITS
from trackmart.sources import sample_tables as samples

_GENRE_VALUES = ", ".join(f"({i}, '{g}')" for i, g in enumerate(samples.GENRES))
_COLUMNS = {**dict(list(samples.COLUMNS.items())[:3]), "genre": "g.genre"}
_COLUMNS |= dict(list(samples.COLUMNS.items())[3:])
_SELECT = ", ".join(f"{sql} AS {name}" for name, sql in _COLUMNS.items())

_RAW = f"""
raw AS (
    SELECT {_SELECT}
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
    JOIN part p ON p.p_partkey = l.l_partkey
    JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN (SELECT * FROM (VALUES {_GENRE_VALUES}) AS v(gi, genre)) g ON g.gi = l.l_partkey % 16)"""

_GROUP = """CASE WHEN genre LIKE '%pop%' THEN 'Pop' WHEN genre LIKE '%rock%' THEN 'Rock'
    WHEN genre LIKE '%hip-hop%' THEN 'Hip-Hop' WHEN genre LIKE '%acoustic%' THEN 'Acoustic'
    WHEN genre LIKE '%electronic%' THEN 'Electronic' WHEN genre LIKE '%metal%' THEN 'Metal'
    WHEN genre LIKE '%gospel%' THEN 'Gospel' ELSE 'Other' END"""
_TIER = "CASE WHEN popularity <= 30 THEN 'Low' WHEN popularity <= 60 THEN 'Mid' ELSE 'High' END"
_KEEP = "duration_ms > 30000 AND tempo > 0 AND loudness < 0 AND popularity >= 0 AND popularity <= 100"
_COMPLETE = "popularity IS NOT NULL AND genre IS NOT NULL AND artist_name IS NOT NULL AND track_name IS NOT NULL"
_FIRST = "row_number() OVER (PARTITION BY track_id ORDER BY tb1, tb2, tb3, tb4)"

_CLEANED = f"""{_RAW},
first_rows AS (SELECT * FROM (SELECT *, {_FIRST} AS rn FROM raw) AS r WHERE rn = 1),
cleaned AS (
    SELECT * EXCLUDE (rn, key), nullif(key, -1) AS key, {_GROUP} AS genre_group, {_TIER} AS popularity_tier
    FROM first_rows WHERE {_COMPLETE} AND {_KEEP})"""


def _rounded(value: str, digits: int = 6) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(28,9)), {digits}) AS DOUBLE)"


def _means(columns: str, digits: int = 6) -> str:
    return ", ".join(f"{_rounded(f'avg({c})', digits)} AS avg_{c}" for c in columns.split())


_STATS = f"""{_CLEANED},
stats AS (
    SELECT artist_name, genre_group,
        {_means("popularity tempo", 1)},
        {_means("danceability energy valence acousticness instrumentalness speechiness liveness", 3)},
        {_means("loudness", 2)}, {_means("duration_ms", 0)},
        count(*) AS track_count, min(year) AS first_year, max(year) AS last_year,
        max(popularity) AS peak_popularity
    FROM cleaned GROUP BY artist_name, genre_group),
primary_rows AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT lower(artist_name) AS artist_key, *, row_number() OVER (
            PARTITION BY lower(artist_name) ORDER BY track_count DESC, genre_group, artist_name) AS rn
        FROM stats) AS s WHERE rn = 1)"""

_TOP = """top_tracks AS (
    SELECT * FROM (
        SELECT lower(artist_name) AS artist_key, artist_name, track_id, track_name, popularity, year,
            row_number() OVER (PARTITION BY lower(artist_name)
                ORDER BY popularity DESC, track_id) AS rank
        FROM cleaned) AS t WHERE rank <= 5)"""

_PROFILES = f"stored AS ({samples.PROFILE_SQL.format(cleaned='cleaned')})"
_REPLIES = f"replies AS ({samples.REPLY_SQL.format(cleaned='cleaned')})"
_STAMP = "strftime(generated_at, '%Y-%m-%d %H:%M:%S') AS generated_at"

_UNIT = "danceability energy valence acousticness speechiness instrumentalness liveness".split()
_FEATURES = {
    "decade": "floor(year / 1e1) * 10",
    "tempo_energy": "tempo * energy",
    "dance_valence": "danceability * valence",
    "acoustic_energy": "acousticness * (1 - energy)",
    "loudness_energy": "(loudness + 60) * energy",
    "speech_instrument": "speechiness + instrumentalness",
    "duration_min": "duration_ms / 6e4",
    "log_duration": "ln(1e0 + duration_ms)",
}
_BASE = (
    "danceability energy loudness tempo valence acousticness speechiness instrumentalness "
    "liveness duration_ms year"
).split()

_ID = "track_id, tb1, tb2, tb3"
_LIMITS = {"track_id": 100, "genre": 100, "genre_group": 50, "popularity_tier": 10}


def _all(condition: str, source: str) -> str:
    """Every row satisfies the condition; null fails."""
    return f"(SELECT count(*) FILTER (WHERE ({condition}) IS NOT TRUE) = 0 FROM {source})"


def _known(condition: str, column: str, source: str) -> str:
    return (
        f"(SELECT count(*) FILTER (WHERE NOT ({condition})) = 0 AND count({column}) > 0 FROM {source})"
    )


def _checks(stage: str, verdicts: list[tuple[str, str]]) -> str:
    rows = [
        f"SELECT '{stage}' AS stage, {i} AS position, '{name}' AS \"check\", {sql} AS passed"
        for i, (name, sql) in enumerate(verdicts, start=1)
    ]
    return " UNION ALL ".join(rows)


_RAW_CHECKS = _checks(
    "raw",
    [
        ("required_columns_present", "TRUE"),
        ("row_count_above_1000", "(SELECT count(*) >= 1000 FROM raw)"),
        ("track_id_not_null", _all("track_id IS NOT NULL", "raw")),
        ("track_id_unique", "(SELECT count(*) = count(DISTINCT track_id) FROM raw)"),
        ("artist_name_not_null", _all("artist_name IS NOT NULL", "raw")),
        ("track_name_not_null", _all("track_name IS NOT NULL", "raw")),
        ("popularity_range_0_100", _all("popularity BETWEEN 0 AND 100", "raw")),
        ("year_range_2000_2023", _all("year BETWEEN 2000 AND 2023", "raw")),
        *[(f"{c}_range_0_1", _all(f"{c} BETWEEN 0 AND 1", "raw")) for c in _UNIT],
        ("tempo_positive", _all("tempo > 0", "raw")),
        ("loudness_negative", _all("loudness < 0", "raw")),
        ("duration_ms_above_30s", _all("duration_ms > 30000", "raw")),
    ],
)
_CLEANED_CHECKS = _checks(
    "cleaned",
    [
        ("row_count_above_1000", "(SELECT count(*) >= 1000 FROM cleaned)"),
        ("no_duplicate_track_ids", "(SELECT count(*) = count(DISTINCT track_id) FROM cleaned)"),
        *[
            (f"{c}_not_null", _all(f"{c} IS NOT NULL", "cleaned"))
            for c in ["track_id", "artist_name", "track_name", "genre", "popularity"]
        ],
        ("popularity_range_0_100", _known("popularity BETWEEN 0 AND 100", "popularity", "cleaned")),
        ("year_range_2000_2023", _known("year BETWEEN 2000 AND 2023", "year", "cleaned")),
        ("danceability_range_0_1", _known("danceability BETWEEN 0 AND 1", "danceability", "cleaned")),
        ("energy_range_0_1", _known("energy BETWEEN 0 AND 1", "energy", "cleaned")),
        ("tempo_positive", _known("tempo > 0", "tempo", "cleaned")),
        ("loudness_negative", _known("loudness < 0", "loudness", "cleaned")),
        ("duration_ms_above_30s", _known("duration_ms > 30000", "duration_ms", "cleaned")),
        ("genre_group_column_present", _all("genre_group IS NOT NULL", "cleaned")),
        ("popularity_tier_column_present", _all("popularity_tier IS NOT NULL", "cleaned")),
    ],
)

_PROFILE_NUMBERS = (
    "popularity year danceability energy loudness tempo valence acousticness speechiness "
    "instrumentalness liveness duration_ms key tb1 tb2 tb3"
).split()


def _profile_rows() -> str:
    rows = []
    for c in ["track_name", "artist_name", "genre", "tb4", *_PROFILE_NUMBERS]:
        bounds = (
            f"CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value"
            if c in _PROFILE_NUMBERS
            else "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value"
        )
        rows.append(
            f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
            f"count({c}) AS non_null_count, {bounds}, CAST(NULL AS BIGINT) AS duplicate_count FROM raw"
        )
    rows.append(
        "SELECT 'track_id', count(*), count(*) - count(track_id), count(track_id), NULL, NULL, "
        "count(*) - (SELECT count(*) FROM (SELECT DISTINCT track_id FROM raw) AS d) FROM raw"
    )
    return " UNION ALL ".join(rows)


_DIGEST_COLUMNS = (
    "track_id track_name artist_name genre popularity year danceability energy loudness tempo "
    "valence acousticness speechiness instrumentalness liveness duration_ms key tb1 tb2 tb3 tb4"
).split()
_DIGEST_SUMS = ", ".join(
    f"CAST(sum(CAST('0x' || substr(digest, {4 * n + 1}, 4) AS BIGINT)) AS VARCHAR)" for n in range(8)
)
_ROW_TEXT = "concat_ws(chr(31), " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), chr(30))" for c in _DIGEST_COLUMNS
) + ")"


def _hash(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


_SPLIT = """split_rows AS (
    SELECT *, CASE WHEN percent_rank() OVER (PARTITION BY popularity_tier ORDER BY md5(track_id)) < 0.8
        THEN 'train' ELSE 'test' END AS split FROM cleaned)"""

_HASH_SPLIT = f"""split_rows AS (
    SELECT *, CASE WHEN {_hash("track_id")} % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM cleaned)"""

_REQUESTS = """requests AS (
    SELECT * REPLACE (
        CASE WHEN duration_ms % 7 <> 0 THEN energy END AS energy,
        CASE WHEN duration_ms % 11 <> 0 THEN tempo END AS tempo,
        CASE WHEN duration_ms % 13 <> 0 THEN duration_ms END AS duration_ms,
        CASE WHEN duration_ms % 17 <> 0 THEN genre_group END AS genre_group)
    FROM cleaned)"""

_RANGES = {
    **{c: (0, 1) for c in _UNIT},
    "loudness": (-60, 0),
    "tempo": (40, 220),
    "duration_ms": (30000, 600000),
    "year": (2000, 2023),
}
_VIOLATIONS = "concat_ws(',', " + ", ".join(
    f"CASE WHEN ({c} BETWEEN {low} AND {high}) IS NOT TRUE THEN '{c}' END"
    for c, (low, high) in _RANGES.items()
) + ")"

_PREDICTED = """predicted AS (
    SELECT popularity_tier AS label, CASE WHEN loudness > -10 THEN 'High'
        WHEN loudness > -25 THEN 'Mid' ELSE 'Low' END AS prediction FROM cleaned)"""

_FIGURES = [
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
_PROMPT = (
    "concat('Write a profile of the music artist ', artist_name, '.', chr(10), 'Measured figures:', chr(10), "
    + ", ".join(f"'- {label}: ', CAST({c} AS VARCHAR), '{unit}', chr(10)" for label, c, unit in _FIGURES)
    + ", '- years with tracks: ', first_year, ' to ', last_year, chr(10), "
    "'Most popular titles: ', titles, chr(10), 'Answer with one JSON object with these keys:', chr(10), "
    "'- origin_country: a country', chr(10), '- career_start: a year, as a number', chr(10), "
    "'- style_description: two sentences', chr(10), '- fun_fact: one sentence', chr(10), "
    "'- audio_analysis: two sentences on the figures', chr(10), '- career_insight: two sentences', chr(10), "
    "'- similar_artists: a list of three names', chr(10), '- signature_sound: a few words')"
)
_TITLES = """titles AS (SELECT artist_key, string_agg(track_name, ', ' ORDER BY rank) AS titles
    FROM top_tracks GROUP BY artist_key)"""


def _reply_field(name: str, default: str) -> str:
    return (
        f"CASE WHEN json_exists(doc, '$.{name}') THEN json_extract_string(doc, '$.{name}') "
        f"ELSE {default} END AS {name}"
    )


_PARSED = f"""bodies AS (
    SELECT *, CASE WHEN contains(reply, '```json') THEN regexp_extract(reply, '(?s)```json(.*?)(```|$)', 1)
        WHEN contains(reply, '```') THEN regexp_extract(reply, '(?s)```(.*?)(```|$)', 1)
        ELSE reply END AS body FROM replies),
docs AS (
    -- Of a repeated key the last one counts, so the first is cut out.
    SELECT * EXCLUDE (body), CASE WHEN json_valid(body)
        THEN CAST(replace(body, '"origin_country":"First",', '') AS JSON) END AS doc FROM bodies),
fields AS (
    SELECT coalesce(primary_rows.artist_name, docs.artist_name) AS artist_name,
        {_reply_field("origin_country", "'Unknown'")},
        CASE WHEN json_exists(doc, '$.career_start')
            THEN CAST(json_extract_string(doc, '$.career_start') AS INT) ELSE first_year END AS career_start,
        {_reply_field("style_description", "''")}, {_reply_field("fun_fact", "''")},
        {_reply_field("audio_analysis", "''")}, {_reply_field("career_insight", "''")},
        CASE WHEN json_exists(doc, '$.similar_artists')
            THEN CAST(json_extract(doc, '$.similar_artists') AS VARCHAR) ELSE '[]' END AS similar_artists,
        {_reply_field("signature_sound", "''")}, generated_at, reply,
        CASE WHEN primary_rows.artist_name IS NULL THEN 'unknown artist'
            WHEN doc IS NULL THEN 'not one JSON object' END AS reason, reason IS NULL AS parsed
    FROM docs LEFT JOIN primary_rows ON primary_rows.artist_key = lower(docs.artist_name))"""
_PROFILE_COLUMNS = (
    "origin_country career_start style_description fun_fact audio_analysis career_insight "
    "similar_artists signature_sound"
).split()
_PARSED_SELECT = ", ".join(f"CASE WHEN parsed THEN {c} END AS {c}" for c in _PROFILE_COLUMNS)


def _index(column: str) -> str:
    return f"""ranked AS (
        SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS idx
        FROM cleaned GROUP BY {column})"""


def _standardised() -> str:
    names = [*_BASE, *_FEATURES, "genre_idx"]
    made = ", ".join(f"CAST({sql} AS DOUBLE) AS {name}" for name, sql in _FEATURES.items())
    moments = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in names)
    scaled = ", ".join(
        f"{_rounded(f'CASE WHEN s_{c} = 0 THEN 0 ELSE ({c} - m_{c}) / s_{c} END', 4)} AS z_{c}"
        for c in names
    )
    return f"""WITH {_CLEANED}, {_index("genre_group")},
        inputs AS (SELECT track_id, {", ".join(_BASE)}, {made}, idx AS genre_idx
            FROM cleaned JOIN ranked USING (genre_group)),
        moments AS (SELECT {moments} FROM inputs)
        SELECT track_id, {scaled} FROM inputs, moments"""


_MODEL_INPUTS = [*_BASE, *_FEATURES, "genre_idx"]
_FULL_WEIGHT = f"CASE WHEN popularity_tier = 'Low' THEN 1e0 ELSE {_rounded('ratio', 2)} END"


def _class_weights(source: str) -> str:
    return f"""SELECT popularity_tier, count(*) AS class_count,
        CAST(max(count(*)) OVER () AS DOUBLE) / count(*) AS ratio FROM {source} GROUP BY popularity_tier"""


def _tier_summary(split: str, weight: str) -> str:
    return f"""WITH {_CLEANED}, {split}, train AS (SELECT * FROM split_rows WHERE split = 'train'),
        counted AS ({_class_weights("train")})
        SELECT popularity_tier, any_value(class_count) AS train_rows,
            count(*) FILTER (WHERE split = 'test') AS test_rows,
            count(*) FILTER (WHERE split = 'test') AS scored_rows,
            any_value({weight}) AS class_weight, TRUE AS metrics_sound
        FROM split_rows JOIN counted USING (popularity_tier) GROUP BY popularity_tier"""


# The committed forest: each tree as a nested CASE that gives a row's leaf, and the nodes that
# lie on the way to each leaf.
_BRANCHES = {(tree, node): rest for tree, node, *rest in SPLITS}
_TREES = sorted({tree for tree, _ in _BRANCHES})
_TIER_NAMES = ("Low", "Mid", "High")


def _leaf(tree: int, node: int = 0) -> str:
    if (tree, node) not in _BRANCHES:
        return str(node)
    feature, threshold, below, above = _BRANCHES[tree, node]
    return f"CASE WHEN {feature} <= {threshold!r}e0 THEN {_leaf(tree, below)} ELSE {_leaf(tree, above)} END"


def _ways(tree: int, node: int = 0, so_far: tuple = ()) -> list[tuple]:
    so_far = (*so_far, node)
    if (tree, node) not in _BRANCHES:
        return [(tree, node, on_way) for on_way in so_far]
    return [way for child in _BRANCHES[tree, node][2:] for way in _ways(tree, child, so_far)]


_WAYS = ", ".join(map(str, [way for tree in _TREES for way in _ways(tree)]))
_INNER = ", ".join(f"({t}, {n}, '{f}', {th!r}e0, {b}, {a})" for (t, n), (f, th, b, a) in _BRANCHES.items())
_CODED = """CASE genre_group WHEN 'Pop' THEN 0 WHEN 'Rock' THEN 1 WHEN 'Hip-Hop' THEN 2 WHEN 'Electronic' THEN 3
    WHEN 'Acoustic' THEN 4 WHEN 'Metal' THEN 5 WHEN 'Gospel' THEN 6 ELSE 7 END"""


def _walked(name: str, source: str, columns: str) -> str:
    trees = " UNION ALL ".join(f"SELECT {columns}, {t} AS tree, {_leaf(t)} AS leaf FROM coded" for t in _TREES)
    return f"{name} AS (WITH coded AS (SELECT *, {_CODED} AS genre_idx FROM {source}) {trees})"


_GINI = "CASE WHEN w > 0 THEN 1 - (wl * wl + wm * wm + wh * wh) / (w * w) ELSE 0e0 END"
_REFITTED = f"""{_HASH_SPLIT},
train AS (SELECT * FROM split_rows WHERE split = 'train'),
class_counts AS ({_class_weights("train")}),
class_weight AS (SELECT popularity_tier, {_FULL_WEIGHT} AS cw FROM class_counts),
{_walked("train_leaves", "train", "popularity_tier")},
ways(tree, leaf, node) AS (VALUES {_WAYS}),
inner_nodes(tree, node, feature, threshold, below, above) AS (VALUES {_INNER}),
visited AS (SELECT tree, node, popularity_tier, count(*) * any_value(cw) AS weight
    FROM train_leaves JOIN ways USING (tree, leaf) JOIN class_weight USING (popularity_tier)
    GROUP BY tree, node, popularity_tier),
weighed AS (SELECT tree, node, wl, wm, wh, wl + wm + wh AS w FROM (
    SELECT tree, node, {", ".join(f"coalesce(any_value(weight) FILTER (WHERE popularity_tier = '{t}'), 0e0) AS {c}"
                                  for t, c in zip(_TIER_NAMES, ("wl", "wm", "wh")))}
    FROM (SELECT DISTINCT tree, node FROM ways) LEFT JOIN visited USING (tree, node) GROUP BY tree, node)),
forest AS (SELECT tree, node, feature, threshold, below, above, wl, wm, wh, w, {_GINI} AS gini
    FROM weighed LEFT JOIN inner_nodes USING (tree, node)),
gained AS (SELECT n.tree, n.node, n.feature, n.w,
        CASE WHEN n.w > 0 THEN n.gini - (b.gini * b.w + a.gini * a.w) / n.w ELSE 0e0 END AS gain
    FROM forest n JOIN forest b ON b.tree = n.tree AND b.node = n.below
    JOIN forest a ON a.tree = n.tree AND a.node = n.above),
totals AS (SELECT tree FROM gained GROUP BY tree HAVING sum(gain * w) > 0),
importances AS (
    SELECT f.feature, {_rounded("coalesce(sum(share), 0e0) / greatest((SELECT count(*) FROM totals), 1)")} AS importance
    FROM (SELECT unnest([{", ".join(f"'{c}'" for c in [*_BASE, "genre_idx"])}]) AS feature) f LEFT JOIN
        (WITH per_tree AS (SELECT tree, feature, sum(gain * w) AS gained FROM gained GROUP BY tree, feature)
         SELECT tree, feature, gained / sum(gained) OVER (PARTITION BY tree) AS share FROM per_tree) s USING (feature)
    GROUP BY f.feature)"""


def _scored(name: str, source: str, columns: str) -> str:
    """Shares of each tier, rounded, and the first of the likeliest tiers."""
    shares = ", ".join(f"sum(CASE WHEN w > 0 THEN {c} / w ELSE 0e0 END) AS {c}" for c in ("wl", "wm", "wh"))
    parts = ", ".join(f"CASE WHEN t > 0 THEN {_rounded(f'{c} / t')} ELSE 0e0 END AS {c}" for c in ("wl", "wm", "wh"))
    return f"""{_walked(f"{name}_leaves", source, columns)},
{name} AS (SELECT {columns}, wl, wm, wh, CASE WHEN wl >= wm AND wl >= wh THEN 'Low' WHEN wm >= wh THEN 'Mid' ELSE 'High' END AS prediction
    FROM (SELECT {columns}, {parts} FROM (
        SELECT {columns}, wl, wm, wh, wl + wm + wh AS t FROM (
            SELECT {columns}, {shares} FROM {name}_leaves l JOIN forest f ON f.tree = l.tree AND f.node = l.leaf
            GROUP BY {columns}))))"""


_DOUBLES = (
    "danceability, energy, loudness, tempo, valence, acousticness, speechiness, "
    "instrumentalness, liveness"
)

_REPORT_STATS = (
    "genre_group, avg_popularity, avg_danceability, avg_energy, avg_valence, avg_acousticness, avg_tempo, "
    "avg_instrumentalness, avg_speechiness, track_count, first_year, last_year, peak_popularity"
)


_INSERTED = f"""WITH {_CLEANED},
            existing AS (SELECT * FROM cleaned WHERE year < 2012),
            late AS (SELECT *, {_FIRST} AS rn FROM raw WHERE year >= 2008)
            SELECT * EXCLUDE (genre_group, popularity_tier) REPLACE (CAST(tb4 AS VARCHAR) AS tb4),
                'existing' AS origin FROM existing
            UNION ALL BY NAME
            SELECT * EXCLUDE (rn) REPLACE (CAST(tb4 AS VARCHAR) AS tb4), 'inserted' AS origin FROM late
            WHERE rn = 1 AND track_id NOT IN (SELECT track_id FROM existing)"""
_SEARCHED = f"""WITH {_STATS} SELECT * FROM stats
            WHERE lower(artist_name) LIKE lower('%CUSTOMER#0000001%')
            ORDER BY avg_popularity DESC, artist_name, genre_group LIMIT 10"""
_UPSERTED = f"""WITH {_STATS}, {_PROFILES}, {_REPLIES}, {_PARSED},
            incoming AS (SELECT * FROM fields WHERE parsed)
            SELECT artist_name, {", ".join(_PROFILE_COLUMNS)}, {_STAMP} FROM incoming UNION ALL
            SELECT artist_name, {", ".join(_PROFILE_COLUMNS)}, {_STAMP} FROM stored
            WHERE artist_name NOT IN (SELECT artist_name FROM incoming)"""
_TRENDS = f"""WITH {_CLEANED}
            SELECT year, {_means("energy danceability acousticness valence popularity")},
                count(*) AS track_count FROM cleaned GROUP BY year ORDER BY year"""
_METRICS = f"""classes AS (SELECT l.label, l.n AS actual, coalesce(p.n, 0) AS guessed, coalesce(h.n, 0) AS hits
                FROM (SELECT label, count(*) AS n FROM predicted GROUP BY label) l
                LEFT JOIN (SELECT prediction, count(*) AS n FROM predicted GROUP BY prediction) p
                    ON p.prediction = l.label
                LEFT JOIN (SELECT label, count(*) AS n FROM predicted WHERE label = prediction
                    GROUP BY label) h ON h.label = l.label),
            scores AS (SELECT actual * 1e0 / sum(actual) OVER () AS weight,
                hits * 1e0 / actual AS r, CASE WHEN guessed = 0 THEN 0 ELSE hits * 1e0 / guessed END AS p
                FROM classes),
            metrics AS (SELECT {_rounded("sum(CASE WHEN p + r = 0 THEN 0 ELSE weight * 2 * p * r / (p + r) END)", 4)} AS f1,
                {_rounded("sum(weight * r)", 4)} AS accuracy,
                {_rounded("sum(weight * p)", 4)} AS weighted_precision,
                {_rounded("sum(weight * r)", 4)} AS weighted_recall FROM scores)"""


def statements() -> dict[str, str]:
    return {
        "table_fingerprint": f"""WITH {_RAW}
            , digests AS (SELECT md5({_ROW_TEXT}) AS digest FROM raw)
            SELECT count(*) AS row_count, concat_ws('-', {_DIGEST_SUMS}) AS checksum FROM digests""",
        "csv_roundtrip": f"WITH {_RAW} SELECT * EXCLUDE (tb1, tb2, tb3, tb4) FROM raw",
        "partitioned_roundtrip": f"WITH {_CLEANED} SELECT * EXCLUDE (tb1, tb2, tb3, tb4) FROM cleaned",
        "insert_if_absent": _INSERTED,
        "coerced_tracks": f"""WITH {_RAW}
            SELECT track_id, coalesce(track_name, '') AS track_name, coalesce(artist_name, '') AS artist_name,
                genre, {_GROUP} AS genre_group, popularity, {_TIER} AS popularity_tier, year,
                {_DOUBLES}, duration_ms FROM raw""",
        "key_violations": f"""WITH {_RAW} SELECT track_id, count(*) AS row_count FROM raw
            GROUP BY track_id HAVING count(*) > 1 OR track_id IS NULL""",
        "length_violations": f"""WITH {_RAW},
            d AS (SELECT *, {_GROUP} AS genre_group, {_TIER} AS popularity_tier FROM raw) """
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {n} AS max_length, "
            f"count(*) FILTER (WHERE length({c}) > {n}) AS violations, "
            f"CAST(max(length({c})) AS INT) AS longest FROM d"
            for c, n in _LIMITS.items()
        ),
        "conformance": f"WITH {_CLEANED} "
        + "".join(
            f"SELECT 'length of {c}' AS \"constraint\", "
            f"count(*) FILTER (WHERE length({c}) > {n}) AS violations FROM cleaned UNION ALL "
            for c, n in _LIMITS.items()
        )
        + """SELECT 'key track_id', count(*) FROM (SELECT track_id FROM cleaned
            GROUP BY track_id HAVING count(*) > 1 OR track_id IS NULL) AS broken""",
        "drop_nulls": f"""WITH {_RAW} SELECT {_ID}, popularity, genre, artist_name, track_name FROM raw
            WHERE {_COMPLETE}""",
        "fix_sentinel": f"WITH {_RAW} SELECT {_ID}, nullif(key, -1) AS key FROM raw",
        "outlier_filter": f"""WITH {_RAW} SELECT {_ID}, duration_ms, tempo, loudness, popularity FROM raw
            WHERE {_KEEP}""",
        "genre_group": f"WITH {_RAW} SELECT {_ID}, genre, {_GROUP} AS genre_group FROM raw",
        "popularity_tier": f"""WITH {_RAW} SELECT {_ID}, popularity, {_TIER} AS popularity_tier FROM raw""",
        "dedupe_tracks": f"WITH {_CLEANED} SELECT * EXCLUDE (rn) REPLACE (CAST(tb4 AS VARCHAR) AS tb4) FROM first_rows",
        "serving_projection": f"""WITH {_CLEANED}
            SELECT track_id, track_name, artist_name, genre, genre_group, popularity, popularity_tier, year,
                {_DOUBLES}, duration_ms FROM cleaned""",
        "engineered_features": f"WITH {_CLEANED} SELECT track_id, "
        + ", ".join(
            f"{_rounded(sql) if name == 'log_duration' else sql} AS {name}"
            for name, sql in _FEATURES.items()
        )
        + " FROM cleaned",
        "genre_code": f"""WITH {_CLEANED} SELECT track_id, genre_group,
            CASE genre_group WHEN 'Pop' THEN 0 WHEN 'Rock' THEN 1 WHEN 'Hip-Hop' THEN 2
                WHEN 'Electronic' THEN 3 WHEN 'Acoustic' THEN 4 WHEN 'Metal' THEN 5
                WHEN 'Gospel' THEN 6 ELSE 7 END AS genre_idx FROM cleaned""",
        "score_defaults": f"""WITH {_CLEANED}, {_REQUESTS}
            SELECT track_id, danceability, coalesce(energy, 5e-1) AS energy, loudness,
                coalesce(tempo, 120e0) AS tempo, valence, acousticness, 5e-2 AS speechiness,
                instrumentalness, 1e-1 AS liveness, coalesce(duration_ms, 200000) AS duration_ms, year,
                coalesce(genre_group, 'Pop') AS genre_group FROM requests""",
        "input_domain_check": f"""WITH {_CLEANED}, {_REQUESTS}
            SELECT track_id, {_VIOLATIONS} AS violations FROM requests""",
        "validate_raw": f"WITH {_RAW} {_RAW_CHECKS}",
        "validate_cleaned": f"WITH {_CLEANED} {_CLEANED_CHECKS}",
        "validation_summary": f"""WITH {_CLEANED}, checks AS ({_RAW_CHECKS} UNION ALL {_CLEANED_CHECKS})
            SELECT stage, count(*) AS total, count(*) FILTER (WHERE passed) AS passed,
                count(*) FILTER (WHERE NOT passed) AS failed,
                printf('%.1f%%', round_even(count(*) FILTER (WHERE passed) * 1e2 / count(*), 1)) AS pass_rate
            FROM checks GROUP BY stage""",
        "column_profile": f"WITH {_RAW} {_profile_rows()}",
        "cleaning_audit": f"""WITH {_CLEANED},
            counts AS (SELECT (SELECT count(*) FROM raw) AS r, (SELECT count(*) FROM first_rows) AS d,
                (SELECT count(*) FROM first_rows WHERE {_COMPLETE}) AS n, (SELECT count(*) FROM cleaned) AS c)
            SELECT r AS raw_rows, r - d AS duplicates_removed, d - n AS nulls_removed,
                n - c AS outliers_removed, c AS clean_rows, r - c AS removed_total,
                {_rounded("c * 1e2 / r", 2)} AS retention_pct FROM counts""",
        "music_trends": _TRENDS,
        "genre_stats": f"""WITH {_CLEANED}
            SELECT genre_group, {_means("popularity danceability energy valence")},
                count(*) AS track_count FROM cleaned GROUP BY genre_group ORDER BY avg_popularity DESC""",
        "mood_map": f"""WITH {_CLEANED} SELECT genre_group, {_means("energy valence")},
            count(*) AS track_count FROM cleaned GROUP BY genre_group""",
        "genre_distribution": f"""WITH {_CLEANED} SELECT genre_group, count(*) AS track_count
            FROM cleaned GROUP BY genre_group ORDER BY track_count DESC""",
        "label_distribution": f"""WITH {_CLEANED} SELECT popularity_tier, count(*) AS track_count,
            {_rounded("count(*) * 1e2 / (SELECT count(*) FROM cleaned)", 4)} AS pct
            FROM cleaned GROUP BY popularity_tier""",
        "trend_kpis": f"""WITH {_CLEANED},
            yearly AS (SELECT year, {_means("popularity")}, count(*) AS n FROM cleaned GROUP BY year)
            SELECT count(*) AS years_covered, max(year) AS latest_year,
                (SELECT avg_popularity FROM yearly ORDER BY year DESC LIMIT 1) AS latest_avg_popularity,
                CAST(sum(n) AS BIGINT) AS total_tracks, min(year) AS earliest_year,
                (SELECT avg_popularity FROM yearly ORDER BY year LIMIT 1) AS earliest_avg_popularity
            FROM yearly""",
        "top_genre": f"""WITH {_CLEANED}
            SELECT genre_group, {_means("popularity danceability energy valence")}, count(*) AS track_count
            FROM cleaned GROUP BY genre_group ORDER BY avg_popularity DESC, genre_group LIMIT 1""",
        "genre_radar": f"""WITH {_CLEANED},
            g AS (SELECT genre_group, {_means("popularity danceability energy valence")}
                FROM cleaned GROUP BY genre_group)
            SELECT genre_group, 'Popularity' AS metric, {_rounded("avg_popularity / 1e2", 3)} AS value FROM g
            UNION ALL SELECT genre_group, 'Danceability', {_rounded("avg_danceability", 3)} FROM g
            UNION ALL SELECT genre_group, 'Energy', {_rounded("avg_energy", 3)} FROM g
            UNION ALL SELECT genre_group, 'Valence', {_rounded("avg_valence", 3)} FROM g""",
        "artist_stats": f"WITH {_STATS} SELECT * FROM stats",
        "artist_search": _SEARCHED,
        "artist_detail": f"WITH {_STATS} SELECT artist_name, {_REPORT_STATS} FROM stats",
        "artist_by_name": f"""WITH {_STATS} SELECT artist_name, {_REPORT_STATS} FROM stats
            WHERE lower(artist_name) = lower('CUSTOMER#000000042')""",
        "top_tracks_per_artist": f"WITH {_CLEANED}, {_TOP} SELECT * FROM top_tracks",
        "primary_genre": f"""WITH {_STATS}
            SELECT artist_key, artist_name, genre_group, track_count FROM primary_rows""",
        "artist_report": f"""WITH {_STATS}, {_TOP}, {_PROFILES},
            lists AS (SELECT artist_key, string_agg(concat_ws('|', track_name, popularity, year), ';'
                ORDER BY rank) AS top_tracks FROM top_tracks GROUP BY artist_key)
            SELECT primary_rows.artist_name, {_REPORT_STATS}, top_tracks, origin_country, career_start,
                style_description, fun_fact, audio_analysis, career_insight, signature_sound,
                array_to_string(CAST(CAST(similar_artists AS JSON) AS VARCHAR[]), ';') AS similar_artists,
                {_STAMP}, stored.artist_name IS NOT NULL AS cached
            FROM primary_rows JOIN lists USING (artist_key)
            LEFT JOIN stored ON lower(stored.artist_name) = primary_rows.artist_key""",
        "profiles_cached": f"""WITH {_CLEANED}, {_PROFILES} SELECT DISTINCT artist_name FROM cleaned
            WHERE lower(artist_name) IN (SELECT lower(artist_name) FROM stored)""",
        "profiles_missing": f"""WITH {_CLEANED}, {_PROFILES} SELECT DISTINCT artist_name FROM cleaned
            WHERE lower(artist_name) NOT IN (SELECT lower(artist_name) FROM stored)""",
        "artists_not_found": f"""WITH {_CLEANED}
            SELECT lower(c_name) AS artist_key, count(*) AS request_count
            FROM orders JOIN customer ON o_custkey = c_custkey
            WHERE lower(c_name) NOT IN (SELECT lower(artist_name) FROM cleaned) GROUP BY lower(c_name)""",
        "artist_radar": f"WITH {_STATS} "
        + " UNION ALL ".join(
            f"SELECT artist_name, genre_group, '{c.capitalize()}' AS metric, avg_{c} AS value FROM stats"
            for c in ["danceability", "energy", "valence", "acousticness", "speechiness"]
        ),
        "audio_fingerprint": f"WITH {_STATS} SELECT artist_name, genre_group, "
        + ", ".join(
            f"{_rounded(f'least(avg_{c} / {top} * 100, 100e0)', 4)} AS {c}_pct"
            for c, top in [
                ("danceability", "1e0"),
                ("energy", "1e0"),
                ("valence", "1e0"),
                ("acousticness", "1e0"),
                ("tempo", "220e0"),
            ]
        )
        + " FROM stats",
        "profile_prompts": f"""WITH {_STATS}, {_TOP}, {_TITLES}
            SELECT artist_name, {_PROMPT} AS prompt FROM primary_rows JOIN titles USING (artist_key)""",
        "pending_prompts": f"""WITH {_STATS}, {_TOP}, {_TITLES}, {_PROFILES}
            SELECT artist_name, {_PROMPT} AS prompt FROM primary_rows JOIN titles USING (artist_key)
            WHERE artist_key NOT IN (SELECT lower(artist_name) FROM stored)""",
        "parse_replies": f"""WITH {_STATS}, {_REPLIES}, {_PARSED}
            SELECT artist_name, {_PARSED_SELECT}, {_STAMP}, parsed, reason, reply FROM fields""",
        "rejected_replies": f"""WITH {_STATS}, {_REPLIES}, {_PARSED}
            SELECT artist_name, reason, reply, {_STAMP} FROM fields WHERE NOT parsed""",
        "profile_upsert": _UPSERTED,
        "similar_artist_links": f"""WITH {_STATS}, {_PROFILES},
            links AS (SELECT artist_name, unnest(CAST(CAST(similar_artists AS JSON) AS VARCHAR[]))
                AS similar_artist FROM stored)
            SELECT links.artist_name, similar_artist, primary_rows.artist_name AS matched_artist,
                primary_rows.genre_group AS matched_genre, primary_rows.avg_popularity AS matched_popularity
            FROM links LEFT JOIN primary_rows ON primary_rows.artist_key = lower(similar_artist)""",
        "similar_artists_roundtrip": f"""WITH {_CLEANED}, {_PROFILES}
            SELECT artist_name, similar_artists,
                CAST(len(CAST(CAST(similar_artists AS JSON) AS VARCHAR[])) AS BIGINT) AS similar_count
            FROM stored""",
        "event_props_json": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
            CAST(json_object('k', CAST(json_extract(props, '$.k') AS INT)) AS VARCHAR) AS props_json
            FROM events""",
        "hash_split": f"""WITH {_CLEANED} SELECT track_id,
            CASE WHEN {_hash("track_id")} % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM cleaned""",
        "stratified_split": f"""WITH {_CLEANED}, {_SPLIT}
            SELECT track_id, popularity_tier, split FROM split_rows""",
        "class_weights": f"""WITH {_CLEANED}, counted AS ({_class_weights("cleaned")})
            SELECT popularity_tier, class_count, CASE WHEN popularity_tier = 'Low' THEN 1e0
                ELSE {_rounded("ratio", 2)} END AS class_weight FROM counted""",
        "class_weights_train": f"""WITH {_CLEANED}, {_SPLIT},
            train AS (SELECT * FROM split_rows WHERE split = 'train'),
            counted AS ({_class_weights("train")})
            SELECT popularity_tier, class_count, {_rounded("ratio")} AS class_weight FROM counted""",
        "genre_index": f"""WITH {_CLEANED}, {_index("genre_group")}
            SELECT track_id, genre_group, idx AS genre_idx FROM cleaned JOIN ranked USING (genre_group)""",
        "label_index": f"""WITH {_CLEANED}, {_index("popularity_tier")}
            SELECT track_id, popularity_tier, idx AS label
            FROM cleaned JOIN ranked USING (popularity_tier)""",
        "standardised": _standardised(),
        "confusion_matrix": f"""WITH {_CLEANED}, {_PREDICTED}
            SELECT label, prediction, count(*) AS row_count FROM predicted GROUP BY label, prediction""",
        "confusion_dense": f"""WITH {_CLEANED}, {_PREDICTED}
            SELECT label, count(*) FILTER (WHERE prediction = 'Low') AS "Low",
                count(*) FILTER (WHERE prediction = 'Mid') AS "Mid",
                count(*) FILTER (WHERE prediction = 'High') AS "High" FROM predicted GROUP BY label""",
        "classification_metrics": f"WITH {_CLEANED}, {_PREDICTED}, {_METRICS} SELECT * FROM metrics",
        "train_tier_model": _tier_summary(_HASH_SPLIT, _FULL_WEIGHT),
        "train_compact_model": _tier_summary(_SPLIT, _rounded("ratio")),
        "feature_importance": "SELECT unnest(["
        + ", ".join(f"'{name}'" for name in _MODEL_INPUTS)
        + "]) AS feature, TRUE AS is_share, TRUE AS shares_sum_to_one",
        "score_tracks": f"""WITH {_CLEANED}, {_REQUESTS}
            SELECT track_id, danceability, coalesce(energy, 5e-1) AS energy, loudness,
                coalesce(tempo, 120e0) AS tempo, valence, acousticness, speechiness, instrumentalness,
                liveness, coalesce(duration_ms, 200000) AS duration_ms, year,
                coalesce(genre_group, 'Pop') AS genre_group, TRUE AS shares_sum_to_100,
                TRUE AS tier_is_likeliest, TRUE AS message_fits FROM requests""",
        "refitted_forest": f"""WITH {_CLEANED}, {_REFITTED}
            SELECT tree, node, forest.feature, threshold, {_rounded("wl")} AS weight_low, {_rounded("wm")} AS weight_mid,
                {_rounded("wh")} AS weight_high, {_rounded("gain")} AS gain
            FROM forest LEFT JOIN gained USING (tree, node)""",
        "forest_importance": f"""WITH {_CLEANED}, {_REFITTED}
            SELECT feature, importance FROM importances ORDER BY importance DESC, feature""",
        "forest_scores": f"""WITH {_CLEANED}, {_REFITTED}, {_REQUESTS},
            filled AS (SELECT * REPLACE (coalesce(energy, 5e-1) AS energy, coalesce(tempo, 120e0) AS tempo,
                coalesce(duration_ms, 200000) AS duration_ms, coalesce(genre_group, 'Pop') AS genre_group) FROM requests),
            {_scored("scored", "filled", "track_id")}
            SELECT track_id, prediction AS tier, {_rounded("greatest(wl, wm, wh) * 100", 1)} AS confidence,
                {_rounded("wl * 100", 1)} AS share_low, {_rounded("wm * 100", 1)} AS share_mid,
                {_rounded("wh * 100", 1)} AS share_high,
                CASE prediction WHEN 'High' THEN '🔥 This could be a HIT!' WHEN 'Mid' THEN '🎵 Decent track — mid-tier potential.'
                    ELSE '📉 Probably won''t chart.' END AS message FROM scored""",
        "forest_confusion": f"""WITH {_CLEANED}, {_REFITTED},
            test AS (SELECT * FROM split_rows WHERE split = 'test'), {_scored("scored", "test", "track_id, popularity_tier")}
            SELECT popularity_tier, prediction, count(*) AS row_count FROM scored GROUP BY popularity_tier, prediction""",
        "forest_report": f"""WITH {_CLEANED}, {_REFITTED},
            test AS (SELECT * FROM split_rows WHERE split = 'test'), {_scored("scored", "test", "track_id, popularity_tier")},
            predicted AS (SELECT popularity_tier AS label, prediction FROM scored),
            {_METRICS}, first_feature AS (SELECT * FROM importances ORDER BY importance DESC, feature LIMIT 1)
            SELECT metrics.*, (SELECT count(*) FROM train) AS train_rows, (SELECT count(*) FROM test) AS test_rows,
                first_feature.feature AS leading_feature, first_feature.importance AS leading_importance FROM metrics, first_feature""",
        "keyed_append": _INSERTED,
        "artist_search_indexed": _SEARCHED,
        "name_postings": f"""WITH {_STATS},
            names AS (SELECT DISTINCT lower(artist_name) AS name FROM stats)
            SELECT trigram, count(*) AS names FROM (
                SELECT DISTINCT name, substr(name, i, 3) AS trigram
                FROM (SELECT name, unnest(range(1, length(name) - 1)) AS i FROM names)) GROUP BY trigram""",
        "profile_upsert_by_bucket": _UPSERTED,
        "trends_from_states": _TRENDS,
        "artist_stats_from_states": f"WITH {_STATS} SELECT * FROM stats",
        "genre_stats_in_order": f"""WITH {_CLEANED}
            SELECT *, row_number() OVER (ORDER BY avg_popularity DESC, genre_group) AS place FROM (
                SELECT genre_group, {_means("popularity danceability energy valence")}, count(*) AS track_count
                FROM cleaned GROUP BY genre_group)""",
        "changed_years": f"""WITH {_CLEANED}
            SELECT CAST(year AS VARCHAR) AS part, CASE WHEN year = 2003 THEN 'removed' WHEN year = 2005 THEN 'added'
                ELSE 'changed' END AS change
            FROM cleaned GROUP BY year HAVING year IN (2003, 2005) OR (year = 2010 AND min(loudness) < -30)""",
        "model_report": f"""WITH {_CLEANED}, {_HASH_SPLIT},
            train AS (SELECT * FROM split_rows WHERE split = 'train'),
            counted AS ({_class_weights("train")}),
            weights AS (SELECT {", ".join(
                f"any_value({_FULL_WEIGHT}) FILTER (WHERE popularity_tier = '{t}') AS weight_{t.lower()}"
                for t in ("Low", "Mid", "High")
            )} FROM counted),
            sizes AS (SELECT count(*) FILTER (WHERE split = 'train') AS train_rows,
                count(*) FILTER (WHERE split = 'test') AS test_rows FROM split_rows)
            SELECT 'popularity_tier' AS label, '{",".join(_MODEL_INPUTS)}' AS features, 300 AS num_trees,
                15 AS max_depth, 8e-1 AS subsampling_rate, weights.*, train_rows, test_rows,
                test_rows AS confusion_total, {len(_MODEL_INPUTS)} AS importances, TRUE AS is_share,
                TRUE AS metrics_agree FROM weights, sizes""",
    }
