"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each stand-in view of :mod:`revlens.plans.views` and each operator step is a
named CTE here; :func:`build` pulls in the CTEs a final SELECT needs, in
dependency order. Names and types of every output column match the Spark
side (counts BIGINT, floors BIGINT, years INTEGER, means rounded).
"""

from __future__ import annotations

import re

from revlens.functions import text as X
from revlens.operators import sentiment as S
from revlens.plans import params as PR
from revlens.schemas import COMPLIMENTS, USER_COLS

_COMP_SQL = ",\n    ".join(f"CAST(c_nationkey % {i + 2} AS BIGINT) AS {c}" for i, c in enumerate(COMPLIMENTS))
_COMP_OUT = ", ".join(f"{c} AS {n}" for c, n in zip(COMPLIMENTS, USER_COLS[2:13]))
_ATTR_FIELDS = ["BikeParking", "WiFi", "RestaurantsPriceRange2", "Ambience", "GoodForMeal"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


CTES: dict[str, str] = {}

CTES["business_raw"] = r"""
  SELECT CAST(p_partkey AS VARCHAR) AS business_id, p_name AS name, p_type AS state, p_brand AS city,
    concat('M', lpad(CAST(p_partkey % 25 AS VARCHAR), 2, '0'), ' ',
           CASE WHEN p_size % 7 = 0 THEN CAST(p_size AS VARCHAR)
                ELSE lpad(CAST(p_size AS VARCHAR), 3, '0') END) AS postal_code,
    CAST(43.0 AS DOUBLE) + p_retailprice / CAST(10000.0 AS DOUBLE) AS latitude,
    CAST(-79.0 AS DOUBLE) - p_size / CAST(100.0 AS DOUBLE) AS longitude,
    CASE WHEN p_size % 11 = 0 THEN NULL
         ELSE (p_size % 9) * CAST(0.5 AS DOUBLE) + CAST(1.0 AS DOUBLE) END AS stars,
    CAST(p_size * 3 AS BIGINT) AS review_count,
    CAST(CASE WHEN p_size % 10 = 0 THEN 0 ELSE 1 END AS BIGINT) AS is_open,
    concat(split_part(p_name, ' ', 1), ', ', split_part(p_name, ' ', 2),
           CASE WHEN p_size % 2 = 0 THEN ', Food Court' ELSE '' END) AS categories,
    CASE p_size % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' END AS a_BikeParking,
    CASE p_size % 4 WHEN 0 THEN 'u''free''' WHEN 1 THEN 'u''no''' WHEN 2 THEN '''paid''' END AS a_WiFi,
    CAST(p_size % 4 + 1 AS VARCHAR) AS a_RestaurantsPriceRange2,
    concat('{''romantic'': ', CASE WHEN p_size % 2 = 0 THEN 'True' ELSE 'False' END,
           ', ''casual'': ', CASE WHEN p_size % 5 < 2 THEN 'True' ELSE 'False' END,
           ', ''', split_part(p_name, ' ', 1), ''': True}') AS a_Ambience,
    CASE WHEN p_size % 6 = 0 THEN '{''dessert'': False, ''latenight'' True}'
         WHEN p_size % 6 = 1 THEN 'None'
         ELSE '{''lunch'': True, ''dinner'': None}' END AS a_GoodForMeal
  FROM part"""

CTES["provinces"] = "SELECT DISTINCT p_type AS code FROM part WHERE p_type <> 'PROMO'"

CTES["business_clean"] = """
  SELECT business_id AS BusinessID, name AS Name, state AS State, city AS City,
         postal_code AS PostalCode, latitude AS Latitude, longitude AS Longitude,
         categories AS Categories, stars AS BusinessStars, review_count AS ReviewCount,
         """ + ", ".join(f"a_{f}" for f in _ATTR_FIELDS) + """
  FROM business_raw
  WHERE is_open = 1 AND postal_code IS NOT NULL AND length(postal_code) = 7
    AND latitude IS NOT NULL AND longitude IS NOT NULL AND stars IS NOT NULL
    AND review_count IS NOT NULL AND categories IS NOT NULL
    AND state IN (SELECT code FROM provinces)"""

CTES["category_rows"] = """
  SELECT BusinessID, Category, TRUE AS Served FROM (
    SELECT BusinessID, upper(trim(c)) AS Category
    FROM (SELECT BusinessID, unnest(string_split(Categories, ',')) AS c FROM business_clean))"""


def _clean_val(v: str) -> str:
    inner = f"upper(trim(regexp_replace(trim({v}), '^u?''(.*)''$', '\\1')))"
    return f"CASE WHEN {inner} = 'NONE' THEN NULL ELSE {inner} END"


_PAIR = r"'([^']*)'\s*:\s*([^,}]*)".replace("'", "''")


def _attr_field_sql(f: str) -> str:
    v = f"a_{f}"
    nested = f"coalesce(starts_with(trim({v}), '{{'), FALSE)"
    scalar = f"SELECT BusinessID, '{f}' AS attr_key, {_clean_val(v)} AS attr_val FROM business_clean WHERE NOT {nested}"
    pairs = (f"SELECT BusinessID, concat('{f}_', trim(k)) AS attr_key, {_clean_val('v')} AS attr_val FROM ("
             f"SELECT BusinessID, unnest(regexp_extract_all({v}, '{_PAIR}', 1)) AS k, "
             f"unnest(regexp_extract_all({v}, '{_PAIR}', 2)) AS v FROM business_clean WHERE {nested})")
    return scalar + "\n  UNION ALL " + pairs


CTES["attribute_rows"] = "\n  UNION ALL ".join(_attr_field_sql(f) for f in _ATTR_FIELDS)

CTES["checkin_raw"] = """
  SELECT CAST(user_id AS VARCHAR) AS business_id,
         concat(strftime(ts, '%Y-%m-%d %H:%M:%S'), ', ',
                strftime(ts + to_days(CAST(floor(value) AS INTEGER)), '%Y-%m-%d %H:%M:%S'), ',') AS date
  FROM events"""

CTES["checkins"] = """
  SELECT BusinessID, try_strptime(trim(t), '%Y-%m-%d %H:%M:%S') AS CheckinDate FROM (
    SELECT business_id AS BusinessID, unnest(string_split(date, ',')) AS t FROM checkin_raw
    WHERE business_id IN (SELECT BusinessID FROM business_clean))
  WHERE t <> ''"""

CTES["review_raw"] = """
  SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS review_id,
         CAST(l_partkey AS VARCHAR) AS business_id, CAST(o_custkey AS VARCHAR) AS user_id,
         concat('Line ', CAST(l_linenumber AS VARCHAR), ' of order ', CAST(l_orderkey AS VARCHAR),
                chr(10), l_returnflag, l_linestatus) AS text,
         strftime(o_orderdate, '%Y-%m-%d') AS date,
         CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS stars,
         CAST(l_quantity AS BIGINT) % 5 AS cool,
         CAST(round(l_tax * 100) AS BIGINT) AS funny,
         CAST(round(l_discount * 100) AS BIGINT) AS useful
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["reviews"] = """
  SELECT review_id AS ReviewID, business_id AS BusinessID, user_id AS UserID,
         regexp_replace(text, chr(10), ' ', 'g') AS Review, TRY_CAST(date AS DATE) AS Date,
         stars AS ReviewStars, cool AS Cool, funny AS Funny, useful AS Useful
  FROM review_raw
  WHERE text IS NOT NULL AND useful IS NOT NULL AND cool IS NOT NULL AND funny IS NOT NULL
    AND stars IS NOT NULL AND stars BETWEEN 0 AND 5
    AND business_id IN (SELECT BusinessID FROM business_clean)"""

CTES["user_raw"] = f"""
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name,
    {_COMP_SQL},
    CAST(floor(abs(c_acctbal)) AS BIGINT) % 50 AS useful, CAST(c_nationkey AS BIGINT) AS funny,
    CAST(floor(abs(c_acctbal)) AS BIGINT) % 7 AS cool,
    CASE WHEN len(friends) > 0 THEN array_to_string(friends, ', ') ELSE 'None' END AS friends,
    CAST(c_nationkey % 5 AS BIGINT) AS fans,
    coalesce(array_to_string(years, ','), '') AS elite,
    coalesce(n, 0) AS review_count, avg_star AS average_stars,
    strftime(first_order, '%Y-%m-%d') AS yelping_since
  FROM customer LEFT JOIN (
    SELECT o_custkey, count(*) AS n,
           avg(CAST(substr(o_orderpriority, 1, 1) AS DOUBLE)) AS avg_star,
           min(o_orderdate) AS first_order,
           list_sort(list_distinct(list(CAST(year(o_orderdate) AS VARCHAR)))) AS years,
           list_sort(list_distinct(list(CAST(o_orderkey % 101 AS VARCHAR))
                                    FILTER (WHERE o_orderstatus = 'P'))) AS friends
    FROM orders GROUP BY o_custkey) o ON c_custkey = o.o_custkey"""

CTES["valid_user_raw"] = "SELECT * FROM user_raw WHERE user_id IN (SELECT UserID FROM reviews)"

CTES["users"] = f"""
  SELECT user_id AS UserID, name AS UserName, {_COMP_OUT},
         useful AS Useful, funny AS Funny, cool AS Cool, fans AS Fans,
         review_count AS ReviewCount, average_stars AS AverageStars,
         TRY_CAST(yelping_since AS DATE) AS MemberSince
  FROM valid_user_raw"""


def _list_rows(col: str, out: str) -> str:
    return f"""
  SELECT DISTINCT UserID, {out} FROM (
    SELECT UserID, trim(x) AS {out} FROM (
      SELECT user_id AS UserID, unnest(string_split({col}, ',')) AS x FROM valid_user_raw))
  WHERE {out} IS NOT NULL AND {out} <> 'None' AND {out} <> ''"""


CTES["user_friends"] = _list_rows("friends", "FriendUserID")
CTES["user_elites"] = _list_rows("elite", "EliteYear")

# ---- geo lookups -------------------------------------------------------------

CTES["postcodes"] = """
  SELECT concat('M', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS Postcode,
         CASE WHEN n_nationkey % 8 = 7 THEN 'Not assigned' ELSE r_name END AS Borough,
         CASE WHEN n_nationkey = 12 THEN 'Not assigned' ELSE n_name END AS Neighbourhood
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""

CTES["postcodes_ok"] = """
  SELECT * FROM postcodes WHERE Borough <> 'Not assigned' AND Neighbourhood <> 'Not assigned'"""

CTES["per_nation"] = """
  SELECT n_nationkey, n_name, pop, pos, """ + ", ".join(_SEGMENTS) + """ FROM nation JOIN (
    SELECT c_nationkey, count(*) AS pop, count(*) FILTER (WHERE c_acctbal > 0) AS pos, """ + \
    ", ".join(f"count(*) FILTER (WHERE c_mktsegment = '{s}') AS {s}" for s in _SEGMENTS) + """
    FROM customer GROUP BY c_nationkey) c ON n_nationkey = c.c_nationkey"""


# ---- text stand-ins and the text layer -------------------------------------------

_NUM = "CAST(substr(source, 4) AS INTEGER)"

CTES["text_classed"] = """
  SELECT documents.*, coalesce(CAST(quality AS BIGINT), doc_id % 2) AS class
  FROM documents LEFT JOIN labels USING (doc_id)"""

CTES["text_reviews"] = """
  SELECT CAST(doc_id AS VARCHAR) AS ReviewID, concat(source, '_q', CAST(class AS VARCHAR)) AS BusinessID,
         concat('u', CAST(doc_id % 97 AS VARCHAR)) AS UserID, text AS Review,
         CASE WHEN class = 1 THEN CAST(5.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS ReviewStars
  FROM text_classed"""

CTES["text_businesses"] = f"""
  SELECT concat(source, '_q', CAST(class AS VARCHAR)) AS BusinessID, source AS Name,
         CASE WHEN {_NUM} % 4 = 3 THEN 'Markham' ELSE 'Toronto' END AS City,
         concat('M', lpad(CAST({_NUM} % 25 AS VARCHAR), 2, '0'), ' 1A', CAST(class AS VARCHAR)) AS PostalCode,
         CAST(43.6 AS DOUBLE) + {_NUM} / CAST(1000.0 AS DOUBLE) AS Latitude,
         CAST(-79.4 AS DOUBLE) - {_NUM} / CAST(1000.0 AS DOUBLE) AS Longitude,
         CASE WHEN class = 1 THEN CAST(5.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS BusinessStars
  FROM (SELECT DISTINCT source FROM documents), (VALUES (0), (1)) AS c(class)"""


# ---- geo, text and recommender layers ----------------------------------------

CTES["geo_shares"] = (
    "SELECT pn.n_name AS Neighbourhood, p.Postcode AS PostCode, "
    + ", ".join(f"CAST({g} AS DOUBLE) / NULLIF(CAST(pop AS DOUBLE), 0) AS {g}" for g in PR.GROUP_COLUMNS)
    + " FROM per_nation pn LEFT JOIN postcodes_ok p ON p.Neighbourhood = pn.n_name")
CTES["geo_labour"] = """
  SELECT l.Neighbourhood, l.NeighbourhoodId, TRY_CAST(l.LabourForceCategory AS INTEGER) AS LabourForceCategory,
         TRY_CAST(l.InLabourForce AS INTEGER) AS InLabourForce, l.Unemployed, p.Postcode AS PostCode
  FROM (SELECT n_name AS Neighbourhood, CAST(n_nationkey AS VARCHAR) AS NeighbourhoodId,
               CAST(pop AS VARCHAR) AS LabourForceCategory, CAST(pos AS VARCHAR) AS InLabourForce,
               CAST(pop - pos AS VARCHAR) AS Unemployed FROM per_nation) l
  LEFT JOIN postcodes_ok p ON p.Neighbourhood = l.Neighbourhood"""

CTES["text_clean"] = rf"""
  SELECT ReviewID, BusinessID, Name, text_ascii,
         regexp_replace(regexp_replace(regexp_replace(text_ascii, '{X.URL}', ' ', 'g'),
                        '{X.PUNCT}', ' ', 'g'), '{X.DIGITS}', ' ', 'g') AS clean_text
  FROM (SELECT r.ReviewID, r.BusinessID, b.Name,
               lower(regexp_replace(r.Review, '{X.NON_ASCII}', '', 'g')) AS text_ascii
        FROM text_reviews r JOIN text_businesses b USING (BusinessID) WHERE b.City = '{PR.TEXT_CITY}')"""


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_PUNCT = _q(X.PUNCTUATION)
CTES["sentiment_words"] = rf"""
  SELECT ReviewID, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (
    SELECT ReviewID, list_transform(list_filter(string_split_regex(text_ascii, '{X.BLANKS}'), lambda x: length(x) > 1),
      lambda x: CASE WHEN length(trim(x, {_PUNCT})) <= 2 THEN x ELSE trim(x, {_PUNCT}) END) AS w FROM text_clean)"""
CTES["sentiment_rules"] = ("SELECT * FROM (VALUES " + ", ".join(
    f"({_q(w)}, CAST({b!r} AS DOUBLE), {k})" for w, (b, k) in S.rule_words().items()) + ") AS r(word, b, k)")
CTES["lexicon"] = ("SELECT * FROM (VALUES " + ", ".join(
    f"({_q(w)}, CAST({v!r} AS DOUBLE))" for w, v in S.LEXICON.items()) + ") AS l(token, valence)")
CTES["lexicon_rated"] = f"""
  SELECT token, valence, high, low FROM (
    SELECT token, high, low, round(least(greatest(ln(((high + 1.0::DOUBLE) / (h + 2.0::DOUBLE))
             / ((low + 1.0::DOUBLE) / (l + 2.0::DOUBLE))), -4), 4), 2) AS valence
    FROM (SELECT w AS token, CAST(sum(up) AS BIGINT) AS high, CAST(sum(1 - up) AS BIGINT) AS low
          FROM (SELECT DISTINCT ReviewID, w FROM sentiment_words) JOIN rated USING (ReviewID) GROUP BY w
          HAVING count(*) >= {PR.LEXICON_LEAST}),
         (SELECT sum(up) AS h, sum(1 - up) AS l FROM rated))
  WHERE valence <> 0"""
CTES["rated"] = f"""
  SELECT c.ReviewID, CAST(r.ReviewStars > {PR.RATING_THRESHOLD} AS BIGINT) AS up
  FROM text_clean c JOIN text_reviews r USING (ReviewID) WHERE text_ascii IS NOT NULL"""


def _sentiment(lexicon: str) -> str:
    """The rules by window functions over the words of each review. The texts are
    in lower case, so capitals do not occur."""
    turn, so, but = S.NEGATION, S.NEVER_SO, S.BUT

    def has(k, flag):
        return f"({k} & {flag}) <> 0"
    factors = [f"CASE WHEN {has('k1', S.NEGATES)} THEN {turn} ELSE 1 END",
               f"CASE WHEN {has('k2', S.NEVER)} AND {has('k1', S.SO)} THEN {so[0]} "
               f"WHEN {has('k2', S.NEGATES)} THEN {turn} ELSE 1 END",
               f"CASE WHEN {has('k3', S.NEVER)} AND ({has('k2', S.SO)} OR {has('k1', S.SO)}) THEN {so[1]} "
               f"WHEN {has('k3', S.NEGATES)} THEN {turn} ELSE 1 END",
               f"CASE WHEN {has('k1', S.LEAST)} AND NOT {has('k2', S.AT)} THEN {turn} ELSE 1 END"]
    c = ", ".join(f"CAST({x} AS DOUBLE) AS c{i + 1}" for i, x in enumerate(factors))
    size = "abs(v)"
    for i, d in enumerate(S.DECAY):
        size = f"greatest({size} + b{i + 1} * CAST({d} AS DOUBLE), 0) * abs(c{i + 1})"
    lags = ", ".join(f"coalesce(lag({x}, {i}) OVER o, 0) AS {x}{i}" for x in "bk" for i in (1, 2, 3))
    q = "length(text_ascii) - length(replace(text_ascii, '?', ''))"
    return f"""
  SELECT ReviewID, BusinessID, Name,
    CASE WHEN text_ascii IS NULL THEN NULL WHEN n = 0 THEN 0 ELSE round(g / (p + g + z), 3) END AS Negative,
    CASE WHEN text_ascii IS NULL THEN NULL WHEN n = 0 THEN 0 ELSE round(z / (p + g + z), 3) END AS Neutral,
    CASE WHEN text_ascii IS NULL THEN NULL WHEN n = 0 THEN 0 ELSE round(p / (p + g + z), 3) END AS Positive,
    CASE WHEN text_ascii IS NULL THEN NULL WHEN n = 0 THEN 0 ELSE round(s / sqrt(s * s + {S.ALPHA}), 4) END AS Compound
  FROM (SELECT *, total + sign(total) * loud AS s,
               pos + n_pos + CASE WHEN pos + n_pos > n_neg - neg THEN loud ELSE 0 END AS p,
               n_neg - neg + CASE WHEN pos + n_pos < n_neg - neg THEN loud ELSE 0 END AS g,
               CAST(n - n_pos - n_neg AS DOUBLE) AS z
        FROM (SELECT t.ReviewID, t.BusinessID, t.Name, t.text_ascii, coalesce(n, 0) AS n, n_pos, n_neg, pos, neg, pos + neg AS total,
                CAST(least(length(text_ascii) - length(replace(text_ascii, '!', '')), {S.EXCLAMATIONS}) AS DOUBLE) * {S.EXCLAMATION}
                + CASE WHEN {q} > {S.QUESTIONS} THEN CAST({S.MANY_QUESTIONS} AS DOUBLE)
                       WHEN {q} > 1 THEN ({q}) * CAST({S.QUESTION} AS DOUBLE) ELSE 0 END AS loud
              FROM text_clean t LEFT JOIN (
                SELECT ReviewID, count(*) AS n, count(*) FILTER (s > 0) AS n_pos, count(*) FILTER (s < 0) AS n_neg,
                       coalesce(sum(s) FILTER (s > 0), 0) AS pos, coalesce(sum(s) FILTER (s < 0), 0) AS neg
                FROM (SELECT ReviewID, coalesce(sign(v) * sign(c1) * sign(c2) * sign(c3) * sign(c4) * {size} * abs(c4)
                               * CASE WHEN i < but THEN {but[0]}::DOUBLE WHEN i > but THEN {but[1]}::DOUBLE ELSE 1 END, 0) AS s
                      FROM (SELECT *, {c} FROM (
                        SELECT ReviewID, i, {lags}, min(CASE WHEN {has('k', S.IS_BUT)} THEN i END) OVER (PARTITION BY ReviewID) AS but,
                               CASE WHEN w = 'kind' AND lead(w) OVER o = 'of' THEN NULL ELSE v END AS v
                        FROM (SELECT s.ReviewID, s.i, s.w, CASE WHEN coalesce(r.b, 0) = 0 THEN l.valence END AS v,
                                     CASE WHEN l.valence IS NULL THEN coalesce(r.b, 0) ELSE 0 END AS b,
                                     CASE WHEN l.valence IS NULL THEN coalesce(r.k, 0) | CASE WHEN contains(s.w, 'n''t') THEN {S.NEGATES} ELSE 0 END
                                          ELSE 0 END AS k
                              FROM sentiment_words s LEFT JOIN {lexicon} l ON l.token = s.w
                              LEFT JOIN sentiment_rules r ON r.word = s.w)
                        WINDOW o AS (PARTITION BY ReviewID ORDER BY i))))
                GROUP BY ReviewID) f ON f.ReviewID = t.ReviewID))"""


CTES["text_sentiment"] = _sentiment("lexicon")
CTES["text_sentiment_rated"] = _sentiment("lexicon_rated")

STOP_WORDS = "(" + ", ".join(_q(w) for w in X.STOP_WORDS) + ")"
CTES["merged_reviews"] = f"""
  SELECT DISTINCT r.BusinessID, r.Review, b.Name AS BusinessName, b.BusinessStars
  FROM text_reviews r JOIN text_businesses b ON r.BusinessID = b.BusinessID WHERE b.City = '{PR.TEXT_CITY}'"""
CTES["merged_parts"] = f"""
  SELECT BusinessID, part, string_agg(Review, ' ' ORDER BY h, Review) AS joined FROM (
    SELECT BusinessID, Review, h, (h * parts) >> 32 AS part FROM (
      SELECT BusinessID, Review, CAST('0x' || substr(md5(Review), 1, 8) AS BIGINT) AS h FROM merged_reviews
      WHERE Review IS NOT NULL)
    JOIN (SELECT BusinessID, CAST(greatest(ceil(sum(length(Review) + 1) / {PR.CHUNK_CHARS}), 1) AS BIGINT) AS parts
          FROM merged_reviews WHERE Review IS NOT NULL GROUP BY BusinessID) USING (BusinessID))
  GROUP BY BusinessID, part"""
CTES["term_freqs"] = f"""
  SELECT BusinessID, term, count(*) AS tf FROM (
    SELECT BusinessID, unnest(list_filter(regexp_extract_all(lower(Review), '\\w+'),
                                          lambda x: x NOT IN {STOP_WORDS})) AS term FROM merged_reviews)
  GROUP BY ALL"""
CTES["term_idfs"] = """
  SELECT term, ln(CAST((SELECT count(DISTINCT BusinessID) FROM merged_reviews) + 1 AS DOUBLE) / (count(*) + 1)) AS idf
  FROM term_freqs GROUP BY term"""

CTES["rec_sentiment"] = """
  SELECT g.BusinessID, avg_neg, avg_neu, avg_pos, avg_composite_score, b.Name,
         replace(b.PostalCode, ' ', '') AS ZipCode, b.Latitude, b.Longitude
  FROM (SELECT BusinessID, CAST(sum(Funny) AS DOUBLE) / CAST(count(*) * 10 AS DOUBLE) AS avg_neg,
               CAST(sum(Cool) AS DOUBLE) / CAST(count(*) * 5 AS DOUBLE) AS avg_neu,
               CAST(sum(Useful) AS DOUBLE) / CAST(count(*) * 10 AS DOUBLE) AS avg_pos,
               CAST(sum(Useful) - sum(Funny) AS DOUBLE) / CAST(count(*) * 10 AS DOUBLE) AS avg_composite_score
        FROM reviews GROUP BY BusinessID) g JOIN business_clean b ON g.BusinessID = b.BusinessID"""
BIZ_SIDE = """s.Name AS BusinessName, s.ZipCode AS BusinessPostalCode,
         substr(s.ZipCode, 1, 3) AS BusinessNeighborhood, s.Latitude, s.Longitude,
         s.avg_neg AS AverageNegative, s.avg_neu AS AverageNeutral, s.avg_pos AS AveragePositive,
         s.avg_composite_score AS AverageComposite"""
CTES["rec_users_sample"] = f"""
  SELECT UserID, UserName, ReviewCount, AverageStars FROM users ORDER BY UserID LIMIT {PR.N_USERS}"""
CTES["rec_cand"] = f"""
  SELECT * FROM (
    SELECT s.BusinessID, u.UserID, u.UserName, u.ReviewCount AS UserReviewCount,
           u.AverageStars AS UserAverageStars, CAST(0 AS INTEGER) AS ReviewStars,
           CAST(dayofyear(DATE '{PR.AS_OF_DATE}') AS INTEGER) AS ReviewDayOfYear, {BIZ_SIDE}
    FROM rec_sentiment s CROSS JOIN rec_users_sample u WHERE s.ZipCode IS NOT NULL) c
  WHERE NOT EXISTS (SELECT 1 FROM reviews r WHERE r.BusinessID = c.BusinessID AND r.UserID = c.UserID)"""




def build(final: str, extra_ctes: dict[str, str] | None = None) -> str:
    """WITH clause holding every CTE that ``final`` (transitively) names."""
    pool = {**CTES, **(extra_ctes or {})}
    order: list[str] = []

    def visit(sql: str) -> None:
        for name, body in pool.items():
            if name not in order and re.search(rf"\b{name}\b", sql):
                visit(body)
                if name not in order:
                    order.append(name)

    visit(final)
    if not order:
        return final.strip()
    return "WITH " + ",\n".join(f"{n} AS ({pool[n]}\n)" for n in order) + "\n" + final.strip()

