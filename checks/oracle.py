"""The SQL (DuckDB) each query is compared with, over the same tables."""

from __future__ import annotations

from reviewlab.functions.lexicon import LEXICON
from reviewlab.functions.stopwords import STOP_WORDS
from reviewlab.functions.syllables import parsed, patterns

QUOTED_STOP_WORDS = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)
LEXICON_ROWS = ", ".join(f"('{w}', {p}::double)" for w, p in LEXICON.items())

FLAT = """
flat AS (
  SELECT cast(doc_id AS varchar) AS review_id, source AS reviewer,
         lang || '-' || cast(doc_id % 25 AS varchar) AS movie,
         CASE WHEN doc_id % 11 = 10 THEN NULL
              ELSE cast(1 + doc_id % 10 AS varchar) END AS rating,
         source || ' on ' || lang AS review_summary, '2024-01-01' AS review_date,
         doc_id % 2 AS spoiler_tag, text AS review_detail,
         cast(doc_id % 7 AS varchar) || ',' || cast(doc_id % 7 + doc_id % 5 AS varchar)
           AS helpful
  FROM documents)"""

CLEANED = f"""
{FLAT},
typed AS (
  SELECT * REPLACE (try_cast(rating AS float) AS rating,
                    regexp_replace(review_detail, '[^A-Za-z0-9 ]', '', 'g') AS review_detail)
  FROM flat WHERE rating IS NOT NULL),
labelled AS (
  SELECT *, cast(CASE WHEN isnan(rating) THEN NULL
                      WHEN cast(rating AS double) >= 6.66 THEN 3
                      WHEN cast(rating AS double) >= 3.33 THEN 2
                      WHEN rating >= 0 THEN 1 END AS float) AS rating_category,
         lower(review_detail) AS cleaned_review
  FROM typed),
cleaned AS (
  SELECT * FROM labelled
  WHERE rating_category IS NOT NULL AND length(cleaned_review) >= 1000)"""

TOKENS = f"""
{CLEANED},
split AS (
  SELECT review_id, rating_category,
         CASE WHEN rtrim(cleaned_review, ' ') = '' AND cleaned_review <> '' THEN []
              ELSE string_split(rtrim(cleaned_review, ' '), ' ') END AS words
  FROM cleaned),
tokens AS (
  SELECT review_id, rating_category, unnest(words) AS word,
         generate_subscripts(words, 1) AS pos
  FROM split),
kept AS (SELECT * FROM tokens WHERE word NOT IN ({QUOTED_STOP_WORDS})),
counts AS (SELECT word, count(*) AS count FROM kept GROUP BY word)"""

TOP = f"""
{TOKENS},
top AS (SELECT word, count FROM counts ORDER BY count DESC, word LIMIT 20)"""

FLESCH = """
cast(CASE WHEN nw > 0
     THEN 206.835::double - 1.015::double * nw / greatest(ns, 1)
          - 84.6::double * greatest(nv, nw) / nw END AS float)"""


def flesch_counts(relation: str) -> str:
    return f"""
measured AS (
  SELECT *, len(regexp_extract_all(lower(review_detail), '[a-z0-9]+')) AS nw,
         len(regexp_extract_all(lower(review_detail), '[.!?]+')) AS ns,
         len(regexp_extract_all(lower(review_detail), '[aeiouy]+')) AS nv
  FROM {relation}),
scored AS (SELECT *, {FLESCH} AS flesch_score FROM measured)"""


SENTIMENT = f"""
lexicon(word, polarity) AS (VALUES {LEXICON_ROWS}),
matched AS (
  SELECT review_id, avg(polarity) AS mean
  FROM tokens JOIN lexicon USING (word) GROUP BY review_id),
felt AS (
  SELECT cleaned.*, cast(coalesce(mean, 0) AS float) AS sentiment_score
  FROM cleaned LEFT JOIN matched USING (review_id))"""

ANALYSED = f"""
{TOKENS},
{SENTIMENT},
{flesch_counts("felt")},
analysed AS (SELECT *, length(cleaned_review) AS review_length FROM scored)"""

TFIDF = f"""
{TOKENS},
tf AS (SELECT review_id, word, count(*) AS tf FROM kept GROUP BY ALL),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY word),
n AS (SELECT count(*) AS n FROM cleaned),
tfidf AS (
  SELECT review_id, word, tf, df, tf * ln((n + 1.0) / (df + 1.0)) AS tfidf
  FROM tf JOIN df USING (word), n)"""

SPLIT = """CASE WHEN cast('0x' || substr(md5(review_id), 1, 8) AS bigint) % 100 < 80
            THEN 'train' ELSE 'test' END"""

# Syllables of words: every pattern bids at every place where it occurs, and the highest bid counts.
PATTERN_ROWS = ", ".join(
    f"('{letters}', {list(bids)})" for letters, bids in map(parsed, patterns())
)
SYLLABLES = f"""
{FLAT},
said AS (
  SELECT review_id, review_detail AS body,
         regexp_extract_all(lower(review_detail), '[a-z0-9]+') AS words
  FROM flat),
spoken AS (
  SELECT word, count(*) AS df FROM (
    SELECT DISTINCT review_id, unnest(words) AS word FROM said) GROUP BY word),
patterns(letters, bids) AS (VALUES {PATTERN_ROWS}),
places AS (
  SELECT word, '.' || word || '.' AS line, unnest(range(1, length(word) + 3)) AS spot FROM spoken),
pieces AS (
  SELECT word, spot, substr(line, spot, n) AS letters
  FROM places, (SELECT DISTINCT length(letters) AS n FROM patterns)
  WHERE spot + n - 1 <= length(line)),
offers AS (
  SELECT word, spot + unnest(range(0, length(letters) + 1)) AS place, unnest(bids) AS bid
  FROM pieces JOIN patterns USING (letters)),
best AS (SELECT word, place, max(bid) AS bid FROM offers GROUP BY ALL),
odd AS (SELECT word, count(*) FILTER (bid % 2 = 1) AS n FROM best GROUP BY word),
syllables AS (
  SELECT word, df, greatest(coalesce(n, 0), 1) AS syllables FROM spoken LEFT JOIN odd USING (word))"""

# Log-odds of words in good and bad training reviews, with a Dirichlet prior of 500 words.
LEARNED = f"""
{TOKENS},
rated AS (
  SELECT word, count(*) FILTER (rating_category = 3) AS positive,
         count(*) FILTER (rating_category = 1) AS negative
  FROM kept WHERE word <> '' AND rating_category IN (1, 3) AND {SPLIT} = 'train' GROUP BY word),
sums AS (SELECT sum(positive)::double AS good, sum(negative)::double AS bad FROM rated),
priors AS (
  SELECT *, positive + 500 * (positive + negative) / (good + bad) AS y,
         negative + 500 * (positive + negative) / (good + bad) AS n
  FROM rated, sums),
odds AS (
  SELECT *, ln(y / (good + 500 - y)) - ln(n / (bad + 500 - n)) AS delta FROM priors),
lexicon AS (
  SELECT word, positive, negative, delta / sqrt(1 / y + 1 / n) AS z,
         round(delta / (1 + abs(delta)), 6) AS polarity
  FROM odds WHERE abs(delta / sqrt(1 / y + 1 / n)) >= 1.96 AND positive + negative >= 5)"""

# Multinomial Naive Bayes with smoothing 1 over the TF-IDF weights of the counted words.
BAYES = f"""
{TFIDF},
vocab AS (SELECT word FROM counts ORDER BY count DESC, word LIMIT 262144),
weights AS (
  SELECT review_id, {SPLIT} AS split, rating_category AS class, word, tfidf
  FROM tfidf JOIN vocab USING (word) JOIN cleaned USING (review_id)),
rows AS (SELECT review_id, {SPLIT} AS split, rating_category AS class FROM cleaned),
classes AS (
  SELECT class, count(*) AS docs, sum(count(*)) OVER () AS all_docs,
         count(*) OVER () AS n_classes
  FROM rows WHERE split = 'train' GROUP BY class),
sums AS (
  SELECT class, word, sum(tfidf) AS s FROM weights WHERE split = 'train' GROUP BY ALL),
class_sums AS (
  SELECT class, sum(s) + (SELECT count(*) FROM vocab) AS total FROM sums GROUP BY class),
row_sums AS (SELECT review_id, sum(tfidf) AS weight FROM weights GROUP BY review_id),
evidence AS (
  SELECT w.review_id, s.class, sum(w.tfidf * ln(s.s + 1)) AS e
  FROM weights w JOIN sums s USING (word) GROUP BY ALL),
likelihood AS (
  SELECT r.review_id, c.class,
         ln(c.docs + 1.0) - ln(c.all_docs + c.n_classes)
         - coalesce(rs.weight, 0) * ln(cs.total) + coalesce(e.e, 0) AS score
  FROM rows r CROSS JOIN classes c JOIN class_sums cs ON cs.class = c.class
  LEFT JOIN row_sums rs ON rs.review_id = r.review_id
  LEFT JOIN evidence e ON e.review_id = r.review_id AND e.class = c.class),
predicted AS (
  SELECT review_id, arg_max(class, score) AS prediction FROM likelihood GROUP BY review_id),
outcome AS (
  SELECT split, class AS rating_category, cast(prediction AS double) AS prediction
  FROM rows JOIN predicted USING (review_id))"""

LINEAR = f"""
{CLEANED},
points AS (
  SELECT review_id, rating_category, length(cleaned_review) AS x, {SPLIT} AS split
  FROM cleaned),
line AS (
  SELECT regr_slope(rating_category::double, x::double) AS a,
         regr_intercept(rating_category::double, x::double) AS b
  FROM points WHERE split = 'train'),
fitted AS (SELECT points.*, a * x + b AS prediction FROM points, line)"""

RECORDS = """
records AS (
  SELECT event_id AS track_id, event_type || ' ' || cast(event_id AS varchar) AS track_name,
         value AS track_price,
         cast(json_extract_string(props, '$.k') AS bigint) AS collection_id,
         'collection ' || json_extract_string(props, '$.k') AS collection_name,
         user_id AS artist_id, 'artist ' || cast(user_id AS varchar) AS artist_name
  FROM events)"""

CONFLICTS = f"""
{RECORDS},
conflicts AS (
  SELECT * FROM records
  UNION ALL
  SELECT * REPLACE ('a ' || track_name AS track_name, 'a ' || collection_name AS collection_name,
    'a ' || artist_name AS artist_name) FROM records WHERE track_id % 2 = 0)"""

FLAT_COLUMNS = """review_id, reviewer, movie, rating, review_summary, review_date,
  spoiler_tag, review_detail, helpful"""

def length_box(group: str) -> str:
    """Box summary of the cleaned length for each value of ``group``."""
    return f"""WITH {CLEANED},
      s AS (SELECT {group}, length(cleaned_review)::double AS v FROM cleaned),
      q AS (SELECT {group}, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
                   quantile_cont(v, 0.75) AS q3 FROM s GROUP BY {group})
      SELECT {group}, count(*) AS n, round(any_value(q1), 4) AS q1,
             round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3,
             round(least(any_value(q1), min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1))), 4)
               AS whisker_low,
             round(greatest(any_value(q3), max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1))), 4)
               AS whisker_high,
             count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1))
               AS outliers
      FROM s JOIN q USING ({group}) GROUP BY {group}"""


ORACLE: dict[str, str] = {
    "flatten_reviews": f"WITH {FLAT} SELECT {FLAT_COLUMNS} FROM flat",
    "clean_reviews": f"""WITH {CLEANED}
      SELECT {FLAT_COLUMNS}, rating_category, cleaned_review FROM cleaned""",
    "rating_category_counts": f"""WITH {CLEANED}
      SELECT rating_category, count(*) AS reviews FROM cleaned GROUP BY 1""",
    "avg_rating_per_movie": f"""WITH {CLEANED}
      SELECT movie, round(avg(rating::double), 6) AS avg_rating FROM cleaned GROUP BY movie
      ORDER BY avg_rating DESC, movie""",
    "review_count_per_reviewer": f"""WITH {CLEANED}
      SELECT reviewer, count(cleaned_review) AS total_reviews FROM cleaned GROUP BY reviewer""",
    "avg_rating_per_reviewer": f"""WITH {CLEANED}
      SELECT reviewer, round(avg(rating::double), 6) AS avg_rating
      FROM cleaned GROUP BY reviewer""",
    "avg_sentiment_per_reviewer": f"""WITH {TOKENS}, {SENTIMENT}
      SELECT reviewer, round(avg(sentiment_score::double), 6) AS avg_sentiment
      FROM felt GROUP BY reviewer""",
    "reviewer_stats": f"""WITH {TOKENS}, {SENTIMENT}
      SELECT reviewer, count(cleaned_review) AS total_reviews,
             round(avg(rating::double), 6) AS avg_rating,
             round(avg(sentiment_score::double), 6) AS avg_sentiment
      FROM felt GROUP BY reviewer""",
    "reviewer_head": f"""WITH {CLEANED}
      SELECT movie, round(avg(rating::double), 6) AS avg_rating
      FROM cleaned GROUP BY movie ORDER BY movie LIMIT 20""",
    "length_rating_corr": f"""WITH {FLAT}
      SELECT round(corr(length(review_detail)::double, rating::double), 6) AS correlation
      FROM flat WHERE rating IS NOT NULL""",
    "long_review_count": f"""WITH {FLAT}
      SELECT count(*) FILTER (WHERE length(review_detail) >= 1000) AS long_reviews
      FROM flat WHERE rating IS NOT NULL""",
    "score_corr_matrix": f"""WITH {ANALYSED},
      long AS (
        SELECT review_id, 'rating' AS name, rating::double AS v FROM analysed
        UNION ALL SELECT review_id, 'flesch_score', flesch_score::double FROM analysed
        UNION ALL SELECT review_id, 'sentiment_score', sentiment_score::double FROM analysed)
      SELECT a.name AS x, b.name AS y, round(corr(a.v, b.v), 6) AS r
      FROM long a JOIN long b USING (review_id) GROUP BY a.name, b.name""",
    "rating_histogram": f"""WITH {CLEANED},
      bounds AS (SELECT min(rating)::double AS lo, max(rating)::double AS hi FROM cleaned),
      bins AS (
        SELECT least(19, floor((rating::double - lo) / ((hi - lo) / 20)))::int AS bin,
               count(*) AS reviews
        FROM cleaned, bounds GROUP BY 1)
      SELECT i::int AS bin, round(lo + i * ((hi - lo) / 20), 6) AS bin_start,
             round(lo + (i + 1) * ((hi - lo) / 20), 6) AS bin_end,
             coalesce(reviews, 0) AS reviews
      FROM range(20) AS r(i) LEFT JOIN bins ON bins.bin = i CROSS JOIN bounds""",
    "flesch_box": f"""WITH {CLEANED}, {flesch_counts("cleaned")},
      s AS (SELECT flesch_score::double AS v FROM scored WHERE flesch_score IS NOT NULL),
      q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
                   quantile_cont(v, 0.75) AS q3 FROM s)
      SELECT count(*) AS n, round(any_value(q1), 4) AS q1,
             round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3,
             round(least(any_value(q1), min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1))), 4)
               AS whisker_low,
             round(greatest(any_value(q3), max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1))), 4)
               AS whisker_high,
             count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1))
               AS outliers
      FROM s, q""",
    "length_box_per_movie": length_box("movie"),
    "length_box_per_reviewer": length_box("reviewer"),
    "sentiment_rating_bins": f"""WITH {TOKENS}, {SENTIMENT}
      SELECT floor(sentiment_score::double / 0.05::double)::bigint AS bin_x, rating,
             count(*) AS reviews
      FROM felt GROUP BY 1, 2""",
    "tokenize_reviews": f"""WITH {TOKENS}
      SELECT split.review_id, len(any_value(split.words))::int AS n_words,
             count(kept.word)::int AS n_kept,
             coalesce(string_agg(kept.word, ' ' ORDER BY kept.pos), '') AS kept_words
      FROM split LEFT JOIN kept USING (review_id) GROUP BY split.review_id""",
    "word_counts": f"WITH {TOKENS} SELECT word, count FROM counts",
    "top_words": f"WITH {TOP} SELECT word, count FROM top",
    "frequent_words": f"WITH {TOP} SELECT word, count FROM top",
    "word_share": f"""WITH {TOKENS},
      real AS (SELECT word, count FROM counts WHERE word NOT IN ('', 'nan')
               ORDER BY count DESC, word LIMIT 20)
      SELECT word, count, round(count / sum(count) OVER (), 6) AS share FROM real""",
    "vocabulary": f"""WITH {TOKENS}
      SELECT row_number() OVER (ORDER BY count DESC, word) - 1 AS term, word, count
      FROM counts""",
    "vocabulary_left_out": f"""WITH {TOKENS},
      terms AS (SELECT count, row_number() OVER (ORDER BY count DESC, word) AS place FROM counts)
      SELECT count(*) AS words, coalesce(sum(count), 0)::bigint AS occurrences
      FROM terms WHERE place > 1000""",
    "tfidf_terms": f"""WITH {TFIDF}
      SELECT review_id, word, tf::int AS tf, df, round(tfidf, 6) AS tfidf FROM tfidf""",
    "flesch_scores": f"""WITH {CLEANED}, {flesch_counts("cleaned")}
      SELECT review_id, round(flesch_score::double, 3) AS flesch_score FROM scored""",
    "flesch_scores_raw_text": f"""WITH {FLAT}, {flesch_counts("flat")}
      SELECT review_id, round(flesch_score::double, 3) AS flesch_score FROM scored""",
    "sentiment_scores": f"""WITH {TOKENS}, {SENTIMENT}
      SELECT review_id, round(sentiment_score::double, 6) AS sentiment_score FROM felt""",
    "sentiment_scores_by_join": f"""WITH {TOKENS},
      lexicon AS (SELECT word, (count % 9 - 4) / 4.0::double AS polarity FROM counts),
      matched AS (
        SELECT review_id, avg(polarity) AS mean
        FROM tokens JOIN lexicon USING (word) GROUP BY review_id)
      SELECT review_id,
             round(cast(coalesce(mean, 0) AS float)::double, 6) AS sentiment_score
      FROM cleaned LEFT JOIN matched USING (review_id)""",
    "analysed_reviews": f"""WITH {ANALYSED}
      SELECT review_id, rating, round(flesch_score::double, 3) AS flesch_score,
             round(sentiment_score::double, 6) AS sentiment_score,
             review_length::int AS review_length
      FROM analysed""",
    "count_features": f"""WITH {TFIDF},
      vocab AS (SELECT word FROM counts ORDER BY count DESC, word LIMIT 262144)
      SELECT review_id, any_value(rating_category) AS rating_category,
             (count(tfidf) FILTER (WHERE tfidf <> 0))::int AS n_terms,
             round(coalesce(sqrt(sum(tfidf * tfidf)), 0), 4) AS norm
      FROM cleaned
      LEFT JOIN (SELECT * FROM tfidf JOIN vocab USING (word)) USING (review_id)
      GROUP BY review_id""",
    "scaled_features": f"""WITH {CLEANED}
      SELECT review_id,
             round(length(cleaned_review) / stddev_samp(length(cleaned_review)) OVER (), 6)
               AS scaled_length,
             round(rating::double / stddev_samp(rating::double) OVER (), 6) AS scaled_rating
      FROM cleaned""",
    "hash_split": f"WITH {CLEANED} SELECT review_id, {SPLIT} AS split FROM cleaned",
    "stratified_split": f"""WITH {CLEANED},
      placed AS (
        SELECT review_id, rating_category, count(*) OVER (PARTITION BY rating_category) AS n,
               row_number() OVER (PARTITION BY rating_category
                                  ORDER BY substr(md5(review_id), 1, 12)) AS place
        FROM cleaned)
      SELECT review_id, rating_category,
             CASE WHEN place <= 4 * (n - 1) // 5 + 1 THEN 'train' ELSE 'test' END AS split
      FROM placed""",
    "row_cap": f"""WITH {FLAT},
      odd AS (SELECT CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'same'
                ELSE cast(doc_id AS varchar) END AS review_id, source AS reviewer,
                lang || '-' || cast(doc_id % 25 AS varchar) AS movie FROM documents)
      SELECT * FROM odd ORDER BY md5(coalesce(review_id, '')), review_id NULLS FIRST,
        reviewer NULLS FIRST, movie NULLS FIRST LIMIT 250""",
    "decision_tree_scored_rows": f"""WITH {CLEANED}
      SELECT {SPLIT} AS split, count(*) AS rows FROM cleaned GROUP BY 1""",
    "chi_square_words": f"""WITH {TOKENS},
      train AS (SELECT review_id, rating_category FROM cleaned WHERE {SPLIT} = 'train'),
      sizes AS (SELECT rating_category, count(*) AS size, sum(count(*)) OVER () AS total
        FROM train GROUP BY 1),
      held AS (SELECT word, rating_category, count(DISTINCT review_id) AS n
        FROM kept JOIN train USING (review_id, rating_category) WHERE word <> '' GROUP BY ALL),
      columns AS (SELECT word, sum(n) AS n FROM held GROUP BY word HAVING sum(n) >= 5),
      cells AS (
        SELECT word, columns.n AS rows, total, size, coalesce(held.n, 0) AS seen,
               columns.n::double * size / total AS present,
               (total - columns.n)::double * size / total AS absent
        FROM columns CROSS JOIN sizes LEFT JOIN held USING (word, rating_category)),
      tested AS (
        SELECT word, rows, count(*) - 1 AS degrees,
               round(coalesce(sum((seen - present) ** 2 / present + CASE WHEN absent > 0
                 THEN (size - seen - absent) ** 2 / absent ELSE 0 END), 0), 9) AS chi_square
        FROM cells GROUP BY word, rows)
      SELECT word, rows::bigint AS rows, round(chi_square, 6) AS chi_square, degrees,
             row_number() OVER (ORDER BY chi_square DESC, word) <= 1000 AS kept
      FROM tested""",
    "word_syllables": f"WITH {SYLLABLES} SELECT word, df, syllables FROM syllables",
    "reading_ease": f"""WITH {SYLLABLES},
      counted AS (
        SELECT review_id, count(*) AS nw, sum(syllables) AS ns
        FROM (SELECT review_id, unnest(words) AS word FROM said) JOIN syllables USING (word)
        GROUP BY review_id)
      SELECT review_id,
        round((206.835::double
          - 1.015::double * nw / greatest(len(regexp_extract_all(body, '[.!?]+')), 1)
          - 84.6::double * ns / nw)::float::double, 3) AS reading_ease
      FROM said LEFT JOIN counted USING (review_id)""",
    "learned_lexicon": f"""WITH {LEARNED}
      SELECT word, positive, negative, round(z, 4) AS z, round(polarity, 4) AS polarity
      FROM lexicon""",
    "learned_sentiment": f"""WITH {LEARNED}
      SELECT cleaned.review_id,
             round(coalesce(avg(polarity), 0)::float::double, 4) AS sentiment_score
      FROM cleaned LEFT JOIN (SELECT review_id, polarity FROM tokens JOIN lexicon USING (word))
        USING (review_id)
      GROUP BY cleaned.review_id""",
    "naive_bayes_words": f"""WITH {BAYES}
      SELECT split, rating_category, prediction, count(*) AS rows FROM outcome GROUP BY ALL""",
    "naive_bayes_words_accuracy": f"""WITH {BAYES}
      SELECT split, 'NaiveBayes' AS model, 'accuracy' AS metric,
             round(avg((prediction = rating_category)::int), 6) AS value, count(*) AS rows
      FROM outcome GROUP BY split""",
    "linear_regression_on_length": f"""WITH {LINEAR}
      SELECT split, 'LinearRegression' AS model, 'rmse' AS metric,
             round(sqrt(avg((prediction - rating_category) ** 2)), 6) AS value,
             count(*) AS rows
      FROM fitted GROUP BY split""",
    "stored_predictions": f"""WITH {LINEAR}
      SELECT review_id, split, rating_category, round(prediction, 6) AS prediction
      FROM fitted""",
    "land_json": f"WITH {FLAT} SELECT {FLAT_COLUMNS} FROM flat",
    "json_blobs": f"""WITH {RECORDS}
      SELECT cast(to_json(records) AS varchar) AS json_blob FROM records
      UNION ALL
      SELECT cast(to_json(conversations) AS varchar) FROM conversations""",
    "json_blob_columns": f"WITH {RECORDS} SELECT * FROM records",
    "rejected_blobs": "SELECT text AS json_blob FROM documents",
    "split_tracks": f"""WITH {CONFLICTS}
      SELECT track_id, min(track_name) AS track_name, min(track_price) AS track_price,
        min(collection_id) AS collection_id, min(artist_id) AS artist_id
      FROM conflicts GROUP BY track_id""",
    "split_collections": f"""WITH {CONFLICTS}
      SELECT collection_id, min(collection_name) AS collection_name
      FROM conflicts WHERE collection_id IS NOT NULL GROUP BY 1""",
    "split_artists": f"""WITH {CONFLICTS}
      SELECT artist_id, min(artist_name) AS artist_name
      FROM conflicts WHERE artist_id IS NOT NULL GROUP BY 1""",
    "csv_word_report": f"WITH {TOP} SELECT word, count FROM top",
    "csv_reviewer_report": f"""WITH {CLEANED}
      SELECT reviewer, round(avg(rating::double), 6) AS avg_rating
      FROM cleaned GROUP BY reviewer""",
    "csv_broken_names": """SELECT text AS reviewer, length(text)::double AS avg_rating
      FROM documents""",
    "land_nested": f"WITH {FLAT} SELECT {FLAT_COLUMNS} FROM flat",
    "land_split_array": f"WITH {FLAT} SELECT {FLAT_COLUMNS} FROM flat",
    "land_new": f"WITH {FLAT} SELECT {FLAT_COLUMNS} FROM flat",
    "land_new_blobs": f"WITH {FLAT} SELECT review_id, reviewer, rating FROM flat",
    "land_json_array": f"WITH {FLAT} SELECT {FLAT_COLUMNS} FROM flat",
    "land_select": f"""WITH {FLAT} SELECT {FLAT_COLUMNS} FROM flat
      WHERE cast(review_id AS bigint) % 3 <> 1""",
    "land_reuse": f"WITH {FLAT} SELECT {FLAT_COLUMNS} FROM flat WHERE spoiler_tag = 0",
    "stage_chain": f"""WITH {CLEANED}
      SELECT 'raw' AS stage, count(*) AS rows FROM flat
      UNION ALL SELECT 'flat', count(*) FROM flat
      UNION ALL SELECT 'cleaned', count(*) FROM cleaned
      UNION ALL SELECT 'features', count(*) FROM cleaned
      UNION ALL SELECT 'predictions', count(*) FROM cleaned
      UNION ALL SELECT 'metrics', count(DISTINCT {SPLIT}) FROM cleaned""",
}

GROUPED = f"""
rows AS (
  SELECT cast(doc_id AS varchar) AS review_id, quality + 1 AS target,
         CASE WHEN contains(text, '!!') THEN 'bangs' WHEN contains(text, '%%%') THEN 'marks'
              WHEN contains(text, ' | ') THEN 'pipes' ELSE 'plain' END AS grp
  FROM documents JOIN labels USING (doc_id)),
placed AS (SELECT *, {SPLIT} AS split FROM rows),
means AS (SELECT grp, avg(target) AS mean FROM placed WHERE split = 'train' GROUP BY grp)"""

SIDE = "CASE WHEN mean > 1.5 THEN 2.0::double ELSE 1.0::double END"

ORACLE |= {
    f"group_{name}": f"""WITH {GROUPED}
      SELECT split, grp, {value} AS predicted, count(*) AS rows
      FROM placed JOIN means USING (grp) GROUP BY ALL"""
    for name, value in {
        "LogisticRegression": SIDE,
        "DecisionTree": SIDE,
        "RandomForest": SIDE,
        "RandomForestRegressor": SIDE,
        "LinearRegression": "round(mean, 6)",
        "DecisionTreeRegressor": "round(mean, 6)",
        "GBTRegressor": "round(mean, 6)",
    }.items()
}

ORACLE |= {
    "hashed_counts": f"""WITH {TOKENS}
      SELECT cleaned.review_id, count(kept.word) AS tokens,
             (SELECT count(*) FROM cleaned) AS documents
      FROM cleaned LEFT JOIN kept USING (review_id) GROUP BY cleaned.review_id""",
    "kmeans_facts": f"""WITH {CLEANED}
      SELECT 5::bigint AS clusters, 5::bigint AS used, count(*) AS reviews,
             0::bigint AS misplaced FROM cleaned""",
    "kmeans_weighted_points": f"""WITH {CLEANED}
      SELECT length(cleaned_review)::double AS review_length, rating::double AS rating,
             count(*)::double AS weight
      FROM cleaned GROUP BY 1, 2""",
    "kmeans_weighted_facts": f"""WITH {CLEANED}
      SELECT 5::bigint AS clusters, 5::bigint AS used, count(*) AS reviews,
             0::bigint AS misplaced, 0::bigint AS moved FROM cleaned""",
    "lda_facts": """SELECT i::int AS topic, 10::bigint AS terms, 10::bigint AS known_terms,
             10::bigint AS falling FROM range(10) AS r(i)""",
    "topic_line_format": f"""WITH {TOKENS},
      placed AS (
        SELECT word, (count % 8) / 8.0::double AS weight,
               row_number() OVER (ORDER BY count DESC, word) - 1 AS place
        FROM counts ORDER BY place LIMIT 30)
      SELECT 'Topic ' || (place % 3) || ': ' ||
             string_agg(word || '(' || weight::varchar || ')', ' ' ORDER BY place)
               AS TopicDetails
      FROM placed GROUP BY place % 3""",
}
# The same rows through files.
ORACLE |= {
    "parquet_word_report": ORACLE["top_words"],
    "text_topic_report": ORACLE["topic_line_format"],
}
