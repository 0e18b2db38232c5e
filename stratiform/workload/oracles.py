"""What each query should give, as SQL over the same tables for another engine.

Amounts are counted in cents and ratings in ten-thousandths, so the SQL works in whole numbers throughout and rounds exactly;
it shares no code with the operators. ``CTES`` names the parts, ``ORACLES`` the final statements.
"""

from __future__ import annotations

import re

ARRIVAL = "l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus"
LINE_ORDER = (
    "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)
WHOLE = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
SPACE = r"' ' || chr(9) || chr(10) || chr(13)"


def ratio(num: str, den: str, shift: int) -> str:
    """num * 10^shift / den in whole numbers, rounded half away from zero, NULL when den is 0."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    if shift >= 0:
        n = f"({n} * {10 ** shift})"
    else:
        d = f"({d} * {10 ** -shift})"
    return (
        f"CASE WHEN {d} = 0 THEN NULL ELSE CAST(sign({n}) * sign({d}) AS HUGEINT)"
        f" * ((2 * abs({n}) + abs({d})) // (2 * abs({d}))) END"
    )


def real(units: str, digits: int) -> str:
    """Whole units of 10^-digits as a double."""
    return f"CAST({units} AS DOUBLE) / {10 ** digits}"


def money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR)"


def cents(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,2)) * 100 AS BIGINT)"


def placeholder(c: str) -> str:
    return f"lower(trim(coalesce({c}, ''))) IN ('', 'none', 'null', 'nan')"


def blank(c: str) -> str:
    return f"trim(coalesce({c}, '')) = ''"


def plain_date(c: str) -> str:
    """Mixed date text in normal form."""
    formats = ("%Y-%m-%d", "%m/%d/%Y", "%d-%m-%Y", "%d/%m/%Y")
    tries = ", ".join(f"try_strptime(trim({c}), '{f}')" for f in formats)
    return f"CAST(CAST(coalesce({tries}) AS DATE) AS VARCHAR)"


def clean(c: str, cast: str = "DECIMAL(18,2)") -> str:
    return f"TRY_CAST(nullif(regexp_replace({c}, '[^0-9.-]', '', 'g'), '') AS {cast})"


def stamp(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def marked(source: str, key: str, arrival: str, signals: tuple[str, ...]) -> str:
    """Every row with what its key group holds."""
    over = f"OVER (PARTITION BY {key} ORDER BY {arrival} {WHOLE})"
    values = ", ".join(
        f"last_value(CASE WHEN NOT ({placeholder(c)}) THEN {c} END IGNORE NULLS) {over} AS v_{c}, "
        f"count(*) FILTER (WHERE NOT ({placeholder(c)})) OVER (PARTITION BY {key}) AS f_{c}"
        for c in signals
    )
    signature = " || chr(1) || ".join(f"trim(coalesce({c}, ''))" for c in signals)
    down = ", ".join(f"{c} DESC" for c in arrival.split(", "))
    return f"""
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {down}) AS rn,
               count(*) OVER (PARTITION BY {key}) AS n_rows, {values},
               min({signature}) OVER (PARTITION BY {key}) <> max({signature}) OVER (PARTITION BY {key}) AS conflict
        FROM {source}"""


def collapsed(source: str, key: str, signals: tuple[str, ...], others: str) -> str:
    cells = ", ".join(f"CASE WHEN {placeholder(c)} AND v_{c} IS NOT NULL THEN v_{c} ELSE {c} END AS {c}" for c in signals)
    gained = " + ".join(f"CASE WHEN {placeholder(c)} AND v_{c} IS NOT NULL THEN 1 ELSE 0 END" for c in signals)
    lost = " + ".join(f"CASE WHEN {placeholder(c)} THEN f_{c} ELSE 0 END" for c in signals)
    return f"""
        SELECT {key}, {cells}, {others}, n_rows, conflict, CAST(n_rows - 1 AS BIGINT) AS n_rejected,
               CAST({gained} AS BIGINT) AS n_recovered, CAST({lost} AS BIGINT) AS n_lost
        FROM {source} WHERE rn = 1"""


GROUP_STATS = """
    count(*) FILTER (WHERE n_rows > 1) AS duplicate_groups,
    CAST(coalesce(sum(n_rows) FILTER (WHERE n_rows > 1), 0) AS BIGINT) AS duplicate_rows,
    count(*) FILTER (WHERE n_rows > 1 AND NOT conflict) AS exact_duplicate_groups,
    count(*) FILTER (WHERE n_rows > 1 AND conflict) AS conflicting_duplicate_groups,
    count(*) FILTER (WHERE n_lost > 0) AS keys_with_potential_value_loss,
    CAST(coalesce(sum(n_lost), 0) AS BIGINT) AS potential_value_loss_cells,
    CAST(coalesce(sum(n_rejected), 0) AS BIGINT) AS rows_rejected_dedup,
    count(*) FILTER (WHERE n_recovered > 0) AS keys_recovered_from_duplicates,
    CAST(coalesce(sum(n_recovered), 0) AS BIGINT) AS cells_recovered_from_duplicates"""

CORE = ("title", "release_date", "budget", "revenue")
EXTENDED = ("genres", "production_countries", "production_companies", "spoken_languages")
RATING = ("avg_rating", "total_ratings", "stg_dev")

LINE_ID = (
    "CASE WHEN l_partkey % 97 = 0 AND l_linenumber <> 1 THEN NULL WHEN l_partkey % 89 = 0 THEN 'x' || l_orderkey"
    " ELSE CAST(l_orderkey AS VARCHAR) END"
)
# A first line arrives before all others.
ARRIVED = f"l_linenumber <> 1, {ARRIVAL}"
UNDATED = "(SELECT * REPLACE (CASE WHEN l_partkey % 5 <> 0 THEN l_shipdate END AS l_shipdate) FROM lineitem)"


def filled(target: str, source: str) -> str:
    return f"CASE WHEN {blank(target)} AND {source} IS NOT NULL THEN {source} ELSE {target} END"


def fills(target: str, source: str) -> str:
    return f"CASE WHEN {blank(target)} AND {source} IS NOT NULL THEN 1 ELSE 0 END"


def latest(source: str, key: str, recency: str, ties: str) -> str:
    number = f"CASE WHEN regexp_full_match(trim({key}), '[0-9]+') THEN TRY_CAST(trim({key}) AS BIGINT) END"
    return f"""
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY num ORDER BY {recency} DESC NULLS LAST, {ties}) AS newest
            FROM (SELECT *, {number} AS num FROM {source}) WHERE num IS NOT NULL
        ) WHERE newest = 1"""


def metrics(source: str, name: str = "production_company", years: tuple[int, int] = (1990, 2024)) -> str:
    """Measures per name and year: revenue in cents, ratings in ten-thousandths, votes in hundredths."""
    votes = "coalesce(total_ratings, 0)"
    weighted = ratio(f"sum(coalesce(r4, 0) * {votes})", f"sum({votes})", 0)
    return f"""
        SELECT {name}, release_year, count(DISTINCT movie_id) AS movies_released,
               sum(CASE WHEN revenue_c > 0 THEN revenue_c ELSE 0 END) AS total_c,
               {ratio("sum(revenue_c)", "count(nullif(revenue_c, 0))", 0)} AS avg_c,
               CASE WHEN sum({votes}) > 0 THEN {weighted} ELSE {ratio("sum(r4)", "count(r4)", 0)} END AS w4,
               {ratio(f"sum({votes})", "count(*)", 2)} AS votes_c,
               max(record_loaded_at) AS record_loaded_at
        FROM {source} WHERE release_year BETWEEN {years[0]} AND {years[1]} GROUP BY {name}, release_year"""


def changed(source: str) -> str:
    """Measures with those of the year observed before, and the change."""
    return f"""
        SELECT *, {ratio("(total_c - prior_c)", "prior_c", 4)} AS pct_c, w4 - prior_w4 AS delta4 FROM (
            SELECT *, lag(total_c) OVER w AS prior_c, lag(w4) OVER w AS prior_w4, lag(release_year) OVER w AS prior_year
            FROM {source} WINDOW w AS (PARTITION BY production_company ORDER BY release_year))"""


def fact(source: str) -> str:
    return f"""
        SELECT *, md5(lower(trim(production_company))) AS production_company_key,
               coalesce(pct_c > 0 AND delta4 >= 0, FALSE) AS improved
        FROM {source}"""


def banded(source: str) -> str:
    """Trend band of each year between 1995 and 2001."""
    return f"""
        SELECT *, CASE
                WHEN seen_year IS NULL THEN 'no_baseline'
                WHEN pct_c IS NULL OR delta4 IS NULL THEN 'declining'
                WHEN delta4 >= 0 AND pct_c < 0 THEN 'rating_up_revenue_down'
                WHEN delta4 >= 0 AND pct_c >= 2000 THEN 'outperforming'
                WHEN delta4 >= 0 THEN 'stable_positive'
                WHEN pct_c >= 0 THEN 'revenue_up_rating_down'
                ELSE 'declining' END AS band
        FROM (SELECT *, lag(release_year) OVER (
                  PARTITION BY production_company_key ORDER BY release_year, production_company) AS seen_year
              FROM {source} WHERE release_year BETWEEN 1995 AND 2001)"""


def summary(source: str) -> str:
    return f"""
        SELECT production_company_key, production_company, count(*) AS years_observed,
               CAST(count(*) FILTER (WHERE improved) AS BIGINT) AS years_improved,
               {ratio("count(*) FILTER (WHERE improved)", "count(*)", 4)} AS consistency4,
               {ratio("sum(pct_c)", "count(pct_c)", 0)} AS mean_pct_c,
               {ratio("sum(delta4)", "count(delta4)", 0)} AS mean_delta4,
               {ratio("sum(w4)", "count(w4)", 0)} AS mean_w4,
               {ratio("sum(total_c)", "count(total_c)", 0)} AS mean_total_c,
               max(release_year) AS latest_year
        FROM {source} WHERE release_year BETWEEN 1995 AND 2001
        GROUP BY production_company_key, production_company HAVING count(*) >= 5"""


def scores(prefix: str) -> str:
    """Score, flags and action of each summarised group; the score in units of 1/30000 is whole, so it rounds exactly."""
    band = "CASE {0} WHEN 'outperforming' THEN 20 WHEN 'stable_positive' THEN 16 WHEN 'rating_up_revenue_down' THEN 10" \
           " WHEN 'revenue_up_rating_down' THEN 10 WHEN 'declining' THEN 4 ELSE 0 END"
    latest_part, dominant_part = band.format("latest_band"), band.format("dominant_band")
    recency = "CASE WHEN gap <= 0 THEN 20 WHEN gap <= 2 THEN 16 WHEN gap <= 5 THEN 10 ELSE 0 END"
    # Each part is scaled to 1/30000: weight * score * 30000.
    total = f"{latest_part} * 675 + {dominant_part} * 375 + least(years_observed, 15) * 200 + {recency} * 300"
    return f"""
        SELECT *, CASE WHEN inactive THEN 'Inactive'
                    WHEN consistency4 > 1500 AND score4 >= 4000 THEN 'Incentivise'
                    WHEN consistency4 > 1500 AND score4 >= 2000 THEN 'Review'
                    ELSE 'Renegotiate' END AS action
        FROM (SELECT *, CASE WHEN inactive THEN 0 ELSE {ratio(f"({total})", "3", 0)} END AS score4
              FROM (SELECT s.*, coalesce(d.band, 'unclassified') AS dominant_band, coalesce(l.band, 'unclassified') AS latest_band,
                           m.top AS analysis_max_year, m.top - s.latest_year AS gap, s.latest_year <= 1999 AS inactive
                    FROM {prefix}_summary s
                    LEFT JOIN {prefix}_dominant d USING (production_company_key)
                    LEFT JOIN {prefix}_latest l USING (production_company_key)
                    CROSS JOIN (SELECT max(release_year) AS top FROM {prefix}_fact WHERE release_year BETWEEN 1995 AND 2001) m))"""


def band_parts(prefix: str) -> dict[str, str]:
    rows = f"FROM {prefix}_banded WHERE band <> 'no_baseline'"
    return {
        f"{prefix}_summary": summary(f"{prefix}_fact"),
        f"{prefix}_dominant": f"""
            SELECT production_company_key, band FROM (
                SELECT production_company_key, band, row_number() OVER (PARTITION BY production_company_key
                       ORDER BY count(*) DESC, max(release_year) DESC, band) AS place
                {rows} GROUP BY production_company_key, band) WHERE place = 1""",
        f"{prefix}_latest": f"""
            SELECT production_company_key, band FROM (
                SELECT production_company_key, band, row_number() OVER (PARTITION BY production_company_key
                       ORDER BY release_year DESC, band) AS place {rows}) WHERE place = 1""",
        f"{prefix}_scored": scores(prefix),
    }


PRICE, QTY = money("l_extendedprice"), money("l_quantity")

CTES: dict[str, str] = {
    "raw_core": f"""
        SELECT {LINE_ID} AS id,
               CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN ' ' WHEN 3 THEN 'None'
                    ELSE l_returnflag || '-' || l_partkey END AS title,
               CASE l_linenumber % 4 WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 2 THEN strftime(l_shipdate, '%m/%d/%Y')
                    WHEN 3 THEN strftime(l_shipdate, '%d-%m-%Y')
                    ELSE CASE WHEN l_suppkey % 2 = 0 THEN 'n/a' ELSE '' END END AS release_date,
               CASE l_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN '$' || {PRICE} WHEN 2 THEN {QTY} ELSE {PRICE} END AS budget,
               CASE l_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN {QTY}
                    WHEN 2 THEN CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 10000 AS DECIMAL(18,2)) AS VARCHAR)
                    WHEN 3 THEN 'unknown'
                    ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 3 AS DECIMAL(18,2)) AS VARCHAR) END AS revenue,
               l_shipdate AS loaded_at, {ARRIVAL}
        FROM lineitem""",
    "raw_extended": f"""
        SELECT {LINE_ID} AS id,
               CASE WHEN l_linenumber % 3 = 0 THEN ' ' ELSE l_returnflag || ',' || l_linestatus END AS genres,
               CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE 'NATION_' || (l_suppkey % 25) END AS production_countries,
               CASE l_linenumber
                    WHEN 1 THEN 'The,Supplier ' || l_suppkey || ',Part House ' || (l_partkey % 300)
                    WHEN 2 THEN 'Lions Gate,LIONSGATE UK,Supplier ' || l_suppkey
                    WHEN 3 THEN ''
                    WHEN 4 THEN 'Supplier ' || l_suppkey || ' | Part House ' || (l_partkey % 300)
                    WHEN 5 THEN 'SUPPLIER ' || l_suppkey || ', ,An'
                    WHEN 6 THEN 'A,An,Part House ' || (l_partkey % 300) END AS production_companies,
               CASE l_partkey % 4 WHEN 0 THEN 'en|fr' WHEN 1 THEN 'nan' WHEN 2 THEN 'en' END AS spoken_languages,
               l_shipdate AS loaded_at, {ARRIVAL}
        FROM lineitem""",
    "raw_ratings": f"""
        SELECT CASE WHEN event_id % 101 <> 0 THEN CAST(event_id - event_id % 3 AS VARCHAR) END AS movie_id,
               CASE event_type WHEN 'click' THEN (event_id % 50) // 10 || '.' || (event_id % 50) % 10
                    WHEN 'view' THEN {money("value")} WHEN 'signup' THEN '-1' WHEN 'error' THEN '' END AS avg_rating,
               CASE WHEN event_type = 'purchase' THEN '' ELSE CAST(user_id * 20 AS VARCHAR) END AS total_ratings,
               {money("value")} AS stg_dev,
               CASE WHEN event_type <> 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS loaded_at,
               ts, event_id
        FROM events""",
    "enrichment": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
               CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority || ' ' || o_orderkey END AS title,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                    WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') ELSE strftime(o_orderdate, '%d-%m-%Y') END END AS release_date,
               {money("o_totalprice")} AS budget,
               CASE WHEN o_orderkey % 8 <> 0 THEN {money("o_totalprice")} END AS revenue,
               CASE o_orderstatus WHEN 'F' THEN 'Drama,Crime' WHEN 'O' THEN 'Comedy' END AS genres,
               'Customer House ' || (o_custkey % 200) AS production_companies,
               'Land ' || (o_custkey % 25) AS production_countries,
               'en' AS spoken_languages,
               (o_orderkey % 101) // 10 || '.' || (o_orderkey % 101) % 10 AS vote_average,
               CASE WHEN o_orderkey % 37 = 0 THEN 'many' ELSE CAST(o_custkey % 60 AS VARCHAR) END AS vote_count,
               CASE o_orderstatus WHEN 'F' THEN 'Released' WHEN 'O' THEN 'RELEASED' ELSE 'Rumored' END AS status
        FROM orders""",
    "enriched": f"SELECT *, {plain_date('release_date')} AS release_date_norm FROM enrichment",
    "marked_core": marked("raw_core", "id", ARRIVED, CORE),
    "kept_core": collapsed("marked_core", "id", CORE, "loaded_at"),
    "filled_core": f"""
        SELECT k.id, {filled("k.title", "e.title")} AS title, {filled("k.budget", "e.budget")} AS budget,
               {filled("k.revenue", "e.revenue")} AS revenue, {plain_date("k.release_date")} AS own_date, e.release_date_norm,
               {fills("k.title", "e.title")} + {fills("k.budget", "e.budget")} + {fills("k.revenue", "e.revenue")} AS n_first,
               k.n_rows, k.conflict, k.n_rejected, k.n_recovered, k.n_lost
        FROM kept_core k LEFT JOIN enriched e ON k.id = e.id""",
    "staged_core": """
        SELECT id, nullif(trim(title), '') AS title, coalesce(own_date, release_date_norm) AS release_date,
               nullif(trim(budget), '') AS budget, nullif(trim(revenue), '') AS revenue,
               TIMESTAMP '2002-01-01 00:00:00' AS loaded_at,
               n_first + CASE WHEN own_date IS NULL AND release_date_norm IS NOT NULL THEN 1 ELSE 0 END AS n_filled,
               coalesce(title, own_date, release_date_norm, budget, revenue) IS NOT NULL AS touched,
               n_rows, conflict, n_rejected, n_recovered, n_lost
        FROM filled_core""",
    "marked_extended": marked("raw_extended", "id", ARRIVED, EXTENDED),
    "kept_extended": collapsed("marked_extended", "id", EXTENDED, "loaded_at"),
    "staged_extended": f"""
        SELECT k.id, {", ".join(f"nullif(trim({filled(f'k.{c}', f'e.{c}')}), '') AS {c}" for c in EXTENDED)},
               TIMESTAMP '2002-01-01 00:00:00' AS loaded_at,
               {" + ".join(fills(f"k.{c}", f"e.{c}") for c in EXTENDED)} AS n_filled,
               coalesce({", ".join(filled(f"k.{c}", f"e.{c}") for c in EXTENDED)}) IS NOT NULL AS touched,
               k.n_rows, k.conflict, k.n_rejected, k.n_recovered, k.n_lost
        FROM kept_extended k LEFT JOIN enriched e ON k.id = e.id""",
    "marked_ratings": marked("raw_ratings", "movie_id", "ts, event_id", RATING),
    "kept_ratings": collapsed("marked_ratings", "movie_id", RATING, "loaded_at"),
    "gated": """
        SELECT u.id AS movie_id, k.avg_rating, k.total_ratings, k.stg_dev, k.loaded_at, e.status IS NOT NULL AS is_matched,
               coalesce(lower(e.status) = 'released' AND TRY_CAST(e.vote_count AS DOUBLE) >= 20, FALSE) AS is_valid,
               e.vote_average, e.vote_count
        FROM (SELECT DISTINCT id FROM raw_core) u
        LEFT JOIN kept_ratings k ON u.id IS NOT DISTINCT FROM k.movie_id LEFT JOIN enriched e ON u.id = e.id""",
    "filled_ratings": f"""
        SELECT *, CASE WHEN is_valid THEN {filled("avg_rating", "vote_average")} ELSE avg_rating END AS rating,
               CASE WHEN is_valid THEN {filled("total_ratings", "vote_count")} ELSE total_ratings END AS votes,
               CASE WHEN is_valid THEN {fills("avg_rating", "vote_average")} + {fills("total_ratings", "vote_count")}
                    ELSE 0 END AS n_filled
        FROM gated""",
    "staged_ratings": f"""
        SELECT movie_id, nullif(trim(rating), '') AS avg_rating, nullif(trim(votes), '') AS total_ratings,
               nullif(trim(stg_dev), '') AS stg_dev, coalesce(loaded_at, '2002-01-01T00:00:00+00:00') AS loaded_at
        FROM filled_ratings WHERE NOT ({blank("rating")} AND {blank("votes")})""",
    "typed_core": f"""
        SELECT num AS movie_id, title, CAST(release_date AS DATE) AS release_date,
               CAST({clean("budget")} * 100 AS BIGINT) AS budget_c, CAST({clean("revenue")} * 100 AS BIGINT) AS revenue_c,
               loaded_at
        FROM ({latest("staged_core", "id", "loaded_at", "id DESC")})""",
    "typed_extended": f"""
        SELECT num AS movie_id, genres, production_countries,
               nullif(regexp_replace(trim(production_companies), '\\s*\\|\\s*', ',', 'g'), '') AS production_companies,
               spoken_languages, loaded_at
        FROM ({latest("staged_extended", "id", "loaded_at", "id DESC")})""",
    "scaled_ratings": f"""
        SELECT num AS movie_id, CASE WHEN r6 < 0 OR r6 > 100000000 THEN NULL WHEN r6 <= 5000000 THEN r6 * 2
                                     WHEN r6 > 10000000 THEN r6 // 10 ELSE r6 END AS r6,
               {clean("total_ratings", "INTEGER")} AS total_ratings,
               CAST({clean("stg_dev", "DECIMAL(10,4)")} * 10000 AS BIGINT) AS dev4,
               CAST(replace(substr(loaded_at, 1, 19), 'T', ' ') AS TIMESTAMP) AS loaded_at
        FROM (SELECT *, CAST({clean("avg_rating", "DECIMAL(18,6)")} * 1000000 AS BIGINT) AS r6
              FROM ({latest("staged_ratings", "movie_id", "loaded_at", "movie_id DESC")}))""",
    "typed_ratings": f"""
        SELECT movie_id, {ratio("r6", "1", -2)} AS r4, total_ratings, dev4,
               {ratio("(r6 - lo)", "(hi - lo)", 6)} AS minmax6,
               round((r6 / 1000000.0 - mean) / nullif(dev, 0), 6) AS zscore, loaded_at
        FROM scaled_ratings, (SELECT min(r6) AS lo, max(r6) AS hi, avg(r6 / 1000000.0) AS mean,
                                     stddev_samp(r6 / 1000000.0) AS dev FROM scaled_ratings)""",
    "base": """
        SELECT m.movie_id, m.title, m.release_date, CAST(year(m.release_date) AS INTEGER) AS release_year, m.budget_c,
               m.revenue_c, r.r4, r.total_ratings, e.genres, e.production_countries, e.production_companies,
               greatest(m.loaded_at, e.loaded_at, r.loaded_at) AS record_loaded_at
        FROM typed_core m LEFT JOIN typed_extended e USING (movie_id) LEFT JOIN typed_ratings r USING (movie_id)
        WHERE m.release_date IS NOT NULL""",
    "repaired_base": """
        SELECT * REPLACE (
                 budget_c * CASE flag WHEN 'original' THEN 1 WHEN 'budget_scaled_×1k' THEN 1000 ELSE 1000000 END AS budget_c,
                 revenue_c * CASE flag WHEN 'both_scaled_×1m' THEN 1000000 ELSE 1 END AS revenue_c)
        FROM (SELECT *, CASE
                  WHEN budget_c > 0 AND budget_c < 100000 AND revenue_c > 0 AND revenue_c < 100000 THEN 'both_scaled_×1m'
                  WHEN budget_c > 0 AND budget_c < 100000 AND revenue_c > 100000000 THEN 'budget_scaled_×1m'
                  WHEN budget_c >= 100000 AND budget_c < 100000000 AND revenue_c >= 10000000000
                       AND revenue_c > 100 * budget_c THEN 'budget_scaled_×1k'
                  ELSE 'original' END AS flag FROM base)""",
    "listed": """
        SELECT movie_id, pos, trim(piece) AS token FROM (
            SELECT movie_id, unnest(string_split(production_companies, ',')) AS piece,
                   generate_subscripts(string_split(production_companies, ','), 1) AS pos
            FROM repaired_base WHERE production_companies IS NOT NULL) WHERE trim(piece) <> ''""",
    "merged": """
        SELECT movie_id, CASE WHEN token IN ('The', 'A', 'An') AND after IS NOT NULL THEN token || ' ' || after ELSE token END AS token
        FROM (SELECT *, lead(token) OVER w AS after, lag(token) OVER w AS before FROM listed
              WINDOW w AS (PARTITION BY movie_id ORDER BY pos))
        WHERE before IS NULL OR before NOT IN ('The', 'A', 'An')""",
    "bridge": """
        SELECT b.*, CASE WHEN regexp_matches(lower(t.token), '^lions\\s*gate') THEN 'Lions Gate Films' ELSE t.token END
               AS production_company
        FROM repaired_base b JOIN merged t USING (movie_id)""",
    "company_metrics": metrics("bridge"),
    "company_changed": changed("company_metrics"),
    "company_fact": fact("company_changed"),
    "company_banded": banded("company_fact"),
    **band_parts("company"),
    "customer_bridge": f"""
        SELECT o_orderkey AS movie_id,
               CASE WHEN o_orderkey % 10 = 0 THEN 'CUSTOMER ' ELSE 'Customer ' END || o_custkey AS production_company,
               CAST(year(o_orderdate) AS INTEGER) AS release_year,
               CASE WHEN o_orderkey % 20 = 0 THEN 0 WHEN o_orderkey % 23 = 0 THEN NULL ELSE {cents("o_totalprice")} END AS revenue_c,
               CASE WHEN o_orderkey % 29 <> 0 THEN (o_orderkey % 100) * 1000 END AS r4,
               CASE WHEN o_orderkey % 31 <> 0 THEN o_orderkey % 50 END AS total_ratings,
               o_orderdate AS record_loaded_at
        FROM orders""",
    "customer_metrics": metrics("customer_bridge"),
    "customer_changed": changed("customer_metrics"),
    "customer_fact": fact("customer_changed"),
    "customer_banded": banded("customer_fact"),
    **band_parts("customer"),
    "supplier_lines": f"""
        SELECT l_orderkey, l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS total_ratings,
               {ratio("sum(CAST(l_quantity AS BIGINT))", "(count(*) * 5)", 4)} AS r4,
               {ratio(f"sum({cents('l_extendedprice')} * (100 - CAST(round(l_discount * 100) AS BIGINT)))", "100", 0)} AS revenue_c
        FROM lineitem GROUP BY l_orderkey, l_suppkey""",
    "supplier_bridge": """
        SELECT l.l_orderkey AS movie_id, s.s_name AS production_company, CAST(year(o.o_orderdate) AS INTEGER) AS release_year,
               l.revenue_c, l.r4, l.total_ratings, o.o_orderdate AS record_loaded_at
        FROM supplier_lines l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "supplier_metrics": metrics("supplier_bridge"),
    "supplier_changed": changed("supplier_metrics"),
    "supplier_fact": fact("supplier_changed"),
    "supplier_banded": banded("supplier_fact"),
    "dirty": f"""
        SELECT o_orderkey,
               CASE o_orderkey % 11 WHEN 0 THEN '12a' WHEN 1 THEN '' WHEN 2 THEN '-1' ELSE ' ' || o_orderkey || ' ' END AS id,
               CASE o_orderkey % 7 WHEN 0 THEN ' ' || chr(9) WHEN 1 THEN NULL WHEN 2 THEN ' NULL ' WHEN 3 THEN 'NaN'
                    ELSE chr(9) || ' ' || o_orderpriority || ' ' || chr(10) END AS title,
               CASE o_orderkey % 5
                    WHEN 0 THEN year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate)
                    WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 2 THEN strftime(o_orderdate, '%d-%m-%Y')
                    WHEN 3 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%Y') END AS release_date,
               CASE o_orderkey % 6 WHEN 0 THEN '$' || format('{{:,}}', {cents("o_totalprice")} // 100) || '.'
                                               || lpad(CAST({cents("o_totalprice")} % 100 AS VARCHAR), 2, '0')
                    WHEN 1 THEN 'n/a' WHEN 2 THEN '' WHEN 3 THEN '1.2.3' ELSE {money("o_totalprice")} || ' USD' END AS budget,
               o_orderstatus || ' | ' || o_orderpriority AS companies
        FROM orders""",
    "ratings_10": """
        SELECT o_orderkey, CASE WHEN r8 < 0 OR r8 > 10000000000 THEN NULL WHEN r8 <= 500000000 THEN r8 * 20
                                WHEN r8 > 1000000000 THEN r8 ELSE r8 * 10 END AS r9
        FROM (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN o_orderkey * 829348951 % 500000000
                         WHEN 2 THEN o_orderkey * 829348951 % 1000000000 WHEN 3 THEN o_orderkey * 829348951 % 10000000000
                         WHEN 4 THEN -1 ELSE 500000000 + o_orderkey % 3 END AS r8 FROM orders)""",
    "amounts": f"""
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 10 <= 2 THEN (o_custkey % 1000) * 100 WHEN o_orderkey % 10 = 9 THEN NULL
                    ELSE {cents("o_totalprice")} END AS budget_c,
               CASE o_orderkey % 10 WHEN 0 THEN (o_custkey % 1000) * 100 + 100 WHEN 1 THEN {cents("o_totalprice")} * 100
                    WHEN 3 THEN {cents("o_totalprice")} * 1000 WHEN 8 THEN NULL ELSE {cents("o_totalprice")} END AS revenue_c
        FROM orders""",
    "movie_dimension": """
        SELECT m.movie_id, m.title, CAST(strftime(m.release_date, '%Y%m%d') AS INTEGER) AS release_date_key, m.release_date,
               m.budget_c, m.revenue_c, e.genres, e.production_countries, e.production_companies, e.spoken_languages,
               greatest(m.loaded_at, e.loaded_at) AS record_loaded_at
        FROM typed_core m LEFT JOIN typed_extended e USING (movie_id)""",
    "core_stats": f"""
        SELECT count(*) AS rows_out, CAST(sum(n_rejected) AS BIGINT) AS rows_rejected,
               count(*) FILTER (WHERE touched) AS rows_touched, CAST(sum(n_filled) AS BIGINT) AS values_filled, {GROUP_STATS}
        FROM staged_core""",
    "extended_stats": f"""
        SELECT count(*) AS rows_out, CAST(sum(n_rejected) AS BIGINT) AS rows_rejected,
               count(*) FILTER (WHERE touched) AS rows_touched, CAST(sum(n_filled) AS BIGINT) AS values_filled, {GROUP_STATS}
        FROM staged_extended""",
    "ratings_stats": f"""
        SELECT CAST(g.rows_out AS BIGINT) AS rows_out, CAST(d.rows_rejected_dedup + g.dropped AS BIGINT) AS rows_rejected,
               g.rows_out AS rows_touched, g.values_filled, d.*, g.enrichment_matched, g.enrichment_rejected
        FROM (SELECT count(*) FILTER (WHERE NOT ({blank("rating")} AND {blank("votes")})) AS rows_out,
                     count(*) FILTER (WHERE {blank("rating")} AND {blank("votes")}) AS dropped,
                     CAST(sum(n_filled) AS BIGINT) AS values_filled,
                     count(*) FILTER (WHERE is_matched) AS enrichment_matched,
                     count(*) FILTER (WHERE is_matched AND NOT is_valid) AS enrichment_rejected
              FROM filled_ratings) g, (SELECT {GROUP_STATS} FROM kept_ratings) d""",
    "quality": """
        SELECT relation, count(*) AS total_rows, count(*) FILTER (WHERE k IS NULL) AS missing_key_rows,
               count(*) - count(DISTINCT k) AS duplicate_key_rows
        FROM (SELECT 'raw.movies_main' AS relation, nullif(trim(id), '') AS k FROM raw_core
              UNION ALL SELECT 'raw.movie_extended', nullif(trim(id), '') FROM raw_extended
              UNION ALL SELECT 'raw.ratings', nullif(trim(movie_id), '') FROM raw_ratings) GROUP BY relation""",
    "layer_rows": """
        SELECT table_name, raw_rows, staged_rows, typed_rows, raw_rows - staged_rows AS raw_minus_staged,
               staged_rows - typed_rows AS staged_minus_typed
        FROM (SELECT 'movies_main' AS table_name, (SELECT count(*) FROM raw_core) AS raw_rows,
                     (SELECT count(*) FROM staged_core) AS staged_rows, (SELECT count(*) FROM typed_core) AS typed_rows
              UNION ALL SELECT 'movie_extended', (SELECT count(*) FROM raw_extended), (SELECT count(*) FROM staged_extended),
                     (SELECT count(*) FROM typed_extended)
              UNION ALL SELECT 'ratings', (SELECT count(*) FROM raw_ratings), (SELECT count(*) FROM staged_ratings),
                     (SELECT count(*) FROM typed_ratings))""",
    "covered": """
        SELECT u AS universe_ids, k AS kept_ids, u - k AS missing_ids
        FROM (SELECT (SELECT count(DISTINCT id) FROM raw_core) AS u, (SELECT count(DISTINCT movie_id) FROM staged_ratings) AS k)""",
    "impact": """
        SELECT count(*) AS exploded_rows_before_filter,
               count(*) FILTER (WHERE trim(piece) = '') AS dropped_blank_company_rows,
               count(*) FILTER (WHERE release_date IS NULL) AS dropped_null_release_year_rows,
               count(*) FILTER (WHERE trim(piece) <> '' AND release_date IS NOT NULL) AS rows_kept_by_bridge_filter
        FROM (SELECT m.release_date, unnest(string_split(coalesce(e.production_companies, ''), ',')) AS piece
              FROM typed_core m LEFT JOIN typed_extended e USING (movie_id))""",
}

REFS = {name: re.compile(rf"\b{name}\b") for name in CTES}


def statement(final: str) -> str:
    """The final select with the parts it needs, in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, pattern in REFS.items():
            if name not in needed and pattern.search(text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(final)
    order = [n for n in CTES if n in needed]
    parts = ", ".join(f"{n} AS ({CTES[n]})" for n in order)
    return f"WITH {parts} {final}" if parts else final


METRIC_COLUMNS = f"""release_year, movies_released, {real("total_c", 2)} AS total_revenue, {real("avg_c", 2)} AS avg_revenue,
    {real("w4", 4)} AS weighted_avg_rating, {real("votes_c", 2)} AS avg_vote_count"""
CHANGE_COLUMNS = f"""{real("prior_c", 2)} AS prior_year_revenue, {real("prior_w4", 4)} AS prior_year_rating,
    {real("pct_c", 2)} AS revenue_yoy_pct, {real("delta4", 4)} AS rating_yoy_delta"""
YEAR_KEY = "CAST(release_year * 10000 + 101 AS INTEGER) AS release_year_start_date_key"
LOADED = f"{stamp('record_loaded_at')} AS record_loaded_at"


def fact_rows(source: str) -> str:
    return f"""SELECT production_company_key, production_company, {YEAR_KEY}, release_year || '-01-01' AS release_year_start_date,
        {METRIC_COLUMNS}, {CHANGE_COLUMNS}, improved AS growth_and_rating_improved, {LOADED} FROM {source}"""


def trend_rows(source: str) -> str:
    return f"""SELECT production_company_key, production_company, {YEAR_KEY}, CAST(seen_year AS DOUBLE) AS prior_observed_year,
        {METRIC_COLUMNS.replace("movies_released,", "")}, {real("pct_c", 2)} AS revenue_yoy_pct,
        {real("delta4", 4)} AS rating_yoy_delta, improved AS growth_and_rating_improved, band AS performance_band, {LOADED}
        FROM {source}"""


SUMMARY_COLUMNS = f"""production_company_key, production_company, years_observed, years_improved,
    {real("consistency4", 4)} AS consistency_ratio, {real("mean_pct_c", 2)} AS avg_revenue_yoy_pct,
    {real("mean_delta4", 4)} AS avg_rating_yoy_delta, {real("mean_w4", 4)} AS avg_weighted_rating,
    {real("mean_total_c", 2)} AS avg_total_revenue, latest_year,
    CAST(latest_year * 10000 + 101 AS INTEGER) AS latest_year_start_date_key"""


def label(c: str) -> str:
    return f"""CASE WHEN inactive THEN 'Inactive' ELSE CASE {c} WHEN 'outperforming' THEN 'Outperforming'
        WHEN 'stable_positive' THEN 'Stable Positive' WHEN 'rating_up_revenue_down' THEN 'Rating Up, Revenue Down'
        WHEN 'revenue_up_rating_down' THEN 'Revenue Up, Rating Down' WHEN 'declining' THEN 'Declining'
        ELSE 'Unclassified' END END"""


LABEL_COLUMNS = f"""CASE WHEN inactive THEN 'inactive' ELSE dominant_band END AS dominant_performance_band,
    {label("latest_band")} AS latest_performance_band, {label("dominant_band")} AS dominant_performance_band_label,
    '⬤' AS performance_dot,
    CASE WHEN inactive THEN '#7A7A7A' ELSE CASE dominant_band WHEN 'outperforming' THEN '#67002E'
        WHEN 'stable_positive' THEN '#A8C1D3' WHEN 'rating_up_revenue_down' THEN '#C480A7'
        WHEN 'revenue_up_rating_down' THEN '#6E98B5' WHEN 'declining' THEN '#364B59' ELSE '#9E9E9E' END END
        AS performance_dot_color_hex"""
SCORE_COLUMNS = f"""gap AS years_since_latest_release, inactive AS is_inactive_studio, gap <= 2 AS is_recently_active,
    {real("score4", 4)} AS weighted_decision_score"""


def scorecard_rows(prefix: str) -> str:
    return f"""SELECT {SUMMARY_COLUMNS}, {SCORE_COLUMNS}, {LABEL_COLUMNS}, action AS studio_action_recommendation
        FROM {prefix}_scored"""


def task_row(stage: str, task: str, origin: tuple[str, str], relation: str, counts: str, message: str, source: str, status: str = "completed") -> str:
    file, parent = origin
    return f"""SELECT 'r1' AS run_id, '{stage}' AS stage_name, '{task}' AS task_name, CAST({file} AS VARCHAR) AS source_file,
        CAST({parent} AS VARCHAR) AS source_relation, '{relation}' AS target_relation, '{status}' AS status, {counts},
        {message} AS error_message, '2002-01-01 08:00:00' AS started_at, TRUE AS clocks_in_order FROM {source}"""


NO_COUNTS = "CAST(NULL AS DOUBLE) AS rows_in, CAST(NULL AS DOUBLE) AS rows_out, CAST(NULL AS DOUBLE) AS rows_rejected"
LANDED_COUNTS = "CAST(count(*) AS DOUBLE) AS rows_in, CAST(count(*) AS DOUBLE) AS rows_out, CAST(0 AS DOUBLE) AS rows_rejected"
STAGED_COUNTS = """CAST(rows_touched + rows_rejected AS DOUBLE) AS rows_in, CAST(rows_out AS DOUBLE) AS rows_out,
    CAST(rows_rejected AS DOUBLE) AS rows_rejected"""


def losses(table: str, source: str, cells: dict[str, str]) -> str:
    """Cells with text, and those whose typed form is NULL, by column."""
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {some}) AS filled_cells,"
        f" count(*) FILTER (WHERE {some} AND ({typed}) IS NULL) AS lost_cells FROM {source}"
        for c, typed in cells.items() for some in [f"nullif(trim({c}, {SPACE}), '') IS NOT NULL"]
    )


def digits(c: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({c}, {SPACE}), '[0-9]+') THEN TRY_CAST(trim({c}, {SPACE}) AS BIGINT) END"


def routed(c: str) -> str:
    """A date by the shape of its text."""
    text = f"trim({c}, {SPACE})"
    shapes = {"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}": "%Y-%m-%d", "[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}": "%m/%d/%Y", "[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}": "%d-%m-%Y"}
    return "CASE " + " ".join(f"WHEN regexp_full_match({text}, '{s}') THEN try_strptime({text}, '{f}')" for s, f in shapes.items()) + " END"


def whole(c: str) -> str:
    """A number without a fraction."""
    number = clean(c, "DECIMAL(20,4)")
    return f"CASE WHEN {number} = floor({number}) THEN TRY_CAST({number} AS INTEGER) END"
STAGED_TEXT = """'dedup_summary: duplicate_groups=' || duplicate_groups || ', conflicting_groups='
    || conflicting_duplicate_groups || ', potential_loss_keys=' || keys_with_potential_value_loss || ', recovered_keys='
    || keys_recovered_from_duplicates || ', recovered_cells=' || cells_recovered_from_duplicates"""


def period(p: str, months: int) -> tuple[str, str]:
    start = f"CAST(date_trunc('{p}', d) AS DATE)"
    return start, f"CAST({start} + INTERVAL {months} MONTH - INTERVAL 1 DAY AS DATE)"


def calendar() -> str:
    cols = []
    for p, n in (("month", 1), ("quarter", 3), ("year", 12)):
        start, end = period(p, n)
        cols += [
            f"CAST({start} AS VARCHAR) AS {p}_start_date", f"CAST({end} AS VARCHAR) AS {p}_end_date",
            f"d = {start} AS is_{p}_start", f"d = {end} AS is_{p}_end",
        ]
    ints = {
        "year_number": "year(d)", "quarter_number": "quarter(d)", "month_number": "month(d)", "day_of_month": "day(d)",
        "day_of_year": "dayofyear(d)", "week_of_year": "weekofyear(d)", "iso_day_of_week": "isodow(d)",
        "date_key": "strftime(d, '%Y%m%d')",
    }
    cols += [f"CAST({e} AS INTEGER) AS {n}" for n, e in ints.items()]
    return f"""SELECT CAST(d AS VARCHAR) AS date_day, dayname(d) AS day_name, monthname(d) AS month_name,
        isodow(d) >= 6 AS is_weekend, {", ".join(cols)}
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT date_trunc('year', min(o_orderdate)) AS lo,
                           greatest(date_trunc('year', max(o_orderdate)), TIMESTAMP '2001-01-01') + INTERVAL 5 YEAR
                           - INTERVAL 1 DAY AS hi FROM orders))"""


def violations(table: str, column: str, test: str, count: str) -> str:
    return f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test, CAST(({count}) AS BIGINT) AS violations"


def nulls(table: str, source: str, columns: dict[str, str]) -> list[str]:
    return [violations(table, c, "not_null", f"SELECT count(*) FILTER (WHERE {e} IS NULL) FROM {source}") for c, e in columns.items()]


def repeats(table: str, source: str, column: str, expr: str) -> str:
    inner = f"SELECT {expr} AS x FROM {source} WHERE {expr} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    return violations(table, column, "unique", f"SELECT count(*) FROM ({inner})")


def declared() -> str:
    """The declared tests; dates and year keys inside the calendar are those between its first and last day."""
    out: list[str] = []
    for t, s in (("stg_movies_main", "typed_core"), ("stg_movie_extended", "typed_extended"), ("stg_ratings", "typed_ratings")):
        out += nulls(t, s, {"movie_id": "movie_id"}) + [repeats(t, s, "movie_id", "movie_id")]
    flags = "('original', 'both_scaled_×1m', 'budget_scaled_×1m', 'budget_scaled_×1k')"
    both = {"movie_id": "movie_id", "production_company": "production_company"}
    out += nulls("int_movie_company_bridge", "bridge", both)
    out.append(violations("int_movie_company_bridge", "budget_correction_flag", "accepted_values",
                          f"SELECT count(DISTINCT flag) FROM bridge WHERE flag NOT IN {flags}"))
    names = {"production_company": "production_company", "release_year": "release_year"}
    out += nulls("int_company_year_metrics", "company_metrics", names)
    first = "(SELECT year(min(release_date)) FROM typed_core)"
    last = "(SELECT greatest(year(max(release_date)), 2001) + 4 FROM typed_core)"
    day_rows = f"(SELECT unnest(generate_series(make_date({first}, 1, 1), make_date({last}, 12, 31), INTERVAL 1 DAY)) AS d)"
    for c in ("date_key", "date_day"):
        out += nulls("dim_date", day_rows, {c: "d"})
    for c in ("date_key", "date_day"):
        out.append(repeats("dim_date", day_rows, c, "d"))
    outside = f"count(*) FILTER (WHERE {{0}} IS NOT NULL AND {{0}} NOT BETWEEN {first} AND {last})"
    out += nulls("dim_movies", "movie_dimension", {"movie_id": "movie_id"})
    out.append(repeats("dim_movies", "movie_dimension", "movie_id", "movie_id"))
    out.append(violations("dim_movies", "release_date_key", "relationships",
                          f"SELECT {outside.format('year(release_date)')} FROM movie_dimension"))
    keyed = "(SELECT DISTINCT md5(lower(trim(production_company))) AS k FROM bridge)"
    out += nulls("dim_production_companies", keyed, {"production_company_key": "k", "production_company": "k"})
    out.append(repeats("dim_production_companies", keyed, "production_company_key", "k"))
    out += nulls("fct_company_year_performance", "company_fact", {
        "production_company_key": "production_company_key", "release_year_start_date_key": "release_year",
        "release_year": "release_year"})
    out.append(violations("fct_company_year_performance", "release_year_start_date_key", "relationships",
                          f"SELECT {outside.format('release_year')} FROM company_fact"))
    out += nulls("fct_movie_ratings", "typed_ratings", {"movie_id": "movie_id"})
    out.append(violations(
        "fct_movie_ratings", "release_date_key", "relationships",
        f"SELECT {outside.format('year(m.release_date)')} FROM typed_ratings r LEFT JOIN movie_dimension m USING (movie_id)"))
    out += nulls("vw_company_year_trends", "company_banded", {
        "production_company_key": "production_company_key", "production_company": "production_company",
        "release_year": "release_year", "release_year_start_date_key": "release_year"})
    out += nulls("vw_high_value_studio_performance", "company_scored", {
        "production_company_key": "production_company_key", "production_company": "production_company"})
    return " UNION ALL ".join(out)


BRIDGE_MONEY = f"{real('budget_c', 2)} AS budget_amount, {real('revenue_c', 2)} AS revenue_amount"
REPAIR_AMOUNTS = CTES["repaired_base"].replace("FROM base)", "FROM amounts)")

FINALS: dict[str, str] = {
    "land_csv": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
               CASE o_orderkey % 5 WHEN 0 THEN 'He said "' || o_orderpriority || '", then' || chr(10) || 'left'
                    WHEN 3 THEN 'NULL' WHEN 4 THEN o_orderpriority END AS title,
               {money("o_totalprice")} AS budget, CAST(NULL AS VARCHAR) AS revenue, '2002-01-01 00:00:00' AS loaded_at
        FROM orders""",
    "land_csv_blocks": """
        SELECT CAST(p_partkey AS VARCHAR) AS id, 'a "' || p_type || '", or b' AS title,
               CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS VARCHAR) END AS budget, CAST(NULL AS VARCHAR) AS revenue FROM part""",
    "land_csv_parallel": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
               CASE WHEN o_orderkey % 3 = 0 THEN 'he said "no"' || chr(10) || '5,6,' || o_orderpriority ELSE 'x,' || o_custkey END AS title,
               o_orderstatus AS budget FROM orders""",
    "land_enrichment": "SELECT * FROM enrichment",
    "land_json_arrays": """
        SELECT CAST(c_custkey AS VARCHAR) AS movie_id, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS avg_rating,
               CASE WHEN c_custkey % 4 <> 0 THEN '7' END AS total_ratings, CAST(NULL AS VARCHAR) AS stg_dev, 't' AS loaded_at
        FROM customer""",
    "land_json_parallel": """
        SELECT CAST(c_custkey AS VARCHAR) AS movie_id, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS avg_rating,
               CASE WHEN c_custkey % 4 <> 0 THEN '7' END AS total_ratings, CAST(NULL AS VARCHAR) AS stg_dev, 't' AS loaded_at
        FROM customer""",
    "land_json": f"""
        SELECT CAST(event_id AS VARCHAR) AS movie_id,
               CASE WHEN event_type <> 'error' THEN {money("value")} END AS avg_rating,
               CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS total_ratings,
               CASE WHEN event_type NOT IN ('error', 'view') THEN {money("value")} END AS stg_dev,
               '2002-01-01T00:00:00+00:00' AS loaded_at
        FROM events""",
    "nullify_text": f"""
        SELECT o_orderkey, {", ".join(f"nullif(trim({c}, {SPACE}), '') AS {c}" for c in ("id", "title", "budget"))} FROM dirty""",
    "blank_flags": f"""
        SELECT o_orderkey, trim(coalesce(title, ''), {SPACE}) = '' AS is_blank,
               lower(trim(coalesce(title, ''), {SPACE})) IN ('', 'none', 'null', 'nan') AS is_placeholder FROM dirty""",
    "normalise_mixed_dates": f"SELECT o_orderkey, {plain_date('release_date')} AS release_date FROM dirty",
    "duplicate_profile": f"""
        SELECT *, CASE WHEN keys_with_potential_value_loss > 0 THEN 'HIGH' WHEN conflicting_duplicate_groups > 0 THEN 'MEDIUM'
                       WHEN duplicate_groups > 0 THEN 'LOW' END AS risk,
               CASE WHEN keys_with_potential_value_loss > 0 THEN 'REVIEW NEEDED'
                    WHEN conflicting_duplicate_groups > 0 THEN 'CHECK CONFLICTS'
                    WHEN duplicate_groups > 0 THEN 'SAFE DEDUP' ELSE 'NO DUPLICATES' END AS dedup_status
        FROM (SELECT {GROUP_STATS} FROM kept_core)""",
    "collapse_duplicates": f"SELECT id, {', '.join(CORE)}, n_rejected, n_recovered FROM kept_core",
    "keep_first": f"""
        SELECT l_orderkey, {", ".join(c for c in LINE_ORDER if c != "l_shipdate")}, {stamp("l_shipdate")} AS l_shipdate
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(f"{c} NULLS LAST" for c in LINE_ORDER)}) AS rn FROM {UNDATED})
        WHERE rn = 1""",
    "latest_per_key": f"""
        SELECT l_partkey, l_orderkey, {", ".join(c for c in LINE_ORDER if c not in ("l_shipdate", "l_partkey"))},
               {stamp("l_shipdate")} AS l_shipdate
        FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY
                 {", ".join(f"{c} DESC NULLS LAST" for c in LINE_ORDER if c != "l_partkey")}, l_orderkey DESC) AS rn FROM {UNDATED})
        WHERE rn = 1""",
    "fill_missing": f"""
        SELECT r.id, {", ".join(f"{filled(f'r.{c}', f'e.{c}')} AS {c}" for c in ("title", "budget", "revenue"))},
               {stamp("r.loaded_at")} AS loaded_at,
               CAST({" + ".join(fills(f"r.{c}", f"e.{c}") for c in ("title", "budget", "revenue"))} AS INTEGER) AS cells_filled
        FROM raw_core r LEFT JOIN enrichment e ON r.id = e.id""",
    "prepare_enrichment": "SELECT * FROM enriched",
    "stage_core": f"SELECT id, {', '.join(CORE)}, {stamp('loaded_at')} AS loaded_at FROM staged_core",
    "stage_core_stats": "SELECT * FROM core_stats",
    "stage_extended": f"SELECT id, {', '.join(EXTENDED)}, {stamp('loaded_at')} AS loaded_at FROM staged_extended",
    "stage_extended_stats": "SELECT * FROM extended_stats",
    "stage_ratings": "SELECT * FROM staged_ratings",
    "stage_ratings_stats": "SELECT * FROM ratings_stats",
    "numeric_keys": """
        SELECT o_orderkey, CASE WHEN regexp_full_match(trim(id), '[0-9]+') THEN TRY_CAST(trim(id) AS DOUBLE) END AS movie_id
        FROM dirty""",
    "clean_amounts": f"SELECT o_orderkey, CAST({clean('budget')} AS DOUBLE) AS budget_amount FROM dirty",
    "route_dates": """
        SELECT o_orderkey, CAST(CAST(CASE
                   WHEN regexp_full_match(release_date, '\\d{4}-\\d{1,2}-\\d{1,2}') THEN try_strptime(release_date, '%Y-%m-%d')
                   WHEN regexp_full_match(release_date, '\\d{1,2}/\\d{1,2}/\\d{4}') THEN try_strptime(release_date, '%m/%d/%Y')
                   WHEN regexp_full_match(release_date, '\\d{1,2}-\\d{1,2}-\\d{4}') THEN try_strptime(release_date, '%d-%m-%Y')
               END AS DATE) AS VARCHAR) AS release_date FROM dirty""",
    "rewrite_delimiters": "SELECT o_orderkey, replace(companies, ' | ', ',') AS companies FROM dirty",
    "harmonise_ratings": f"SELECT o_orderkey, {real(ratio('r9', '1', -5), 4)} AS rating_10 FROM ratings_10",
    "minmax_ratings": f"""
        SELECT o_orderkey, {real("r9", 9)} AS rating_10, {real(ratio("(r9 - lo)", "(hi - lo)", 6), 6)} AS rating_minmax
        FROM ratings_10, (SELECT min(r9) AS lo, max(r9) AS hi FROM ratings_10)""",
    "zscore_ratings": f"""
        SELECT o_orderkey, {real("r9", 9)} AS rating_10, round((r9 / 1000000000.0 - mean) / nullif(dev, 0), 6) AS rating_zscore
        FROM ratings_10, (SELECT avg(r9 / 1000000000.0) AS mean, stddev_samp(r9 / 1000000000.0) AS dev FROM ratings_10)""",
    "typed_layers": """
        SELECT 'stg_movies_main' AS table_name, count(*) AS n_rows FROM typed_core
        UNION ALL SELECT 'stg_movie_extended', count(*) FROM typed_extended
        UNION ALL SELECT 'stg_ratings', count(*) FROM typed_ratings""",
    "typed_core": f"""
        SELECT movie_id, title, CAST(release_date AS VARCHAR) AS release_date, {BRIDGE_MONEY}, {stamp("loaded_at")} AS loaded_at
        FROM typed_core""",
    "typed_extended": f"""
        SELECT movie_id, genres, production_countries, production_companies, spoken_languages, {stamp("loaded_at")} AS loaded_at
        FROM typed_extended""",
    "typed_ratings": f"""
        SELECT movie_id, {real("r4", 4)} AS avg_rating, CAST(total_ratings AS DOUBLE) AS total_ratings, {real("dev4", 4)} AS std_dev,
               {real("minmax6", 6)} AS avg_rating_minmax, zscore AS avg_rating_zscore, {stamp("loaded_at")} AS loaded_at
        FROM typed_ratings""",
    "base_join": f"""
        SELECT movie_id, title, CAST(release_date AS VARCHAR) AS release_date, release_year, {BRIDGE_MONEY},
               {real("r4", 4)} AS avg_rating, CAST(total_ratings AS DOUBLE) AS total_ratings, genres, production_countries, production_companies, {LOADED}
        FROM base""",
    "explode_list": f"""
        SELECT id, {stamp("loaded_at")} AS loaded_at, CAST(pos AS INTEGER) AS pos, trim(piece) AS production_company
        FROM (SELECT id, loaded_at, unnest(string_split(production_companies, ',')) AS piece,
                     generate_subscripts(string_split(production_companies, ','), 1) AS pos
              FROM raw_extended WHERE production_companies IS NOT NULL) WHERE trim(piece) <> ''""",
    "merge_articles": """
        SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS INTEGER) AS pos,
               CASE WHEN word IN ('The', 'A', 'An') AND after IS NOT NULL THEN word || ' ' || after ELSE word END AS item
        FROM (SELECT *, lead(word) OVER w AS after, lag(word) OVER w AS before
              FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word,
                           generate_subscripts(string_split(text, ' '), 1) AS place FROM documents)
              WHERE word <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY place))
        WHERE before IS NULL OR before NOT IN ('The', 'A', 'An')""",
    "repair_amounts": f"""
        SELECT o_orderkey, {BRIDGE_MONEY}, flag AS budget_correction_flag FROM ({REPAIR_AMOUNTS})""",
    "standardise_by_rules": """
        SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 AND p_partkey % 20000 < 10000 THEN 'Part ' || (p_partkey % 20000)
                               WHEN p_partkey % 2 = 0 THEN 'PART' || (p_partkey % 20000) || '  of set'
                               WHEN p_name LIKE 'small wid%' THEN 'Small Widgets' WHEN p_name LIKE 'small%' THEN 'Plain House'
                               WHEN p_name LIKE 'red%' THEN 'Red House' ELSE p_name END AS p_name FROM part""",
    "standardise_names": """
        SELECT p_partkey, CASE WHEN p_name LIKE 'small%' OR p_name LIKE 'red%' THEN 'Plain House'
                               WHEN p_name LIKE '%widget' THEN 'Widget House' ELSE p_name END AS p_name FROM part""",
    "company_bridge": f"""
        SELECT movie_id, title, CAST(release_date AS VARCHAR) AS release_date, release_year, {BRIDGE_MONEY},
               {real("r4", 4)} AS avg_rating, CAST(total_ratings AS DOUBLE) AS total_ratings, genres, production_countries, production_company,
               flag AS budget_correction_flag, {LOADED}
        FROM bridge""",
    "group_year_metrics": f"SELECT production_company, {METRIC_COLUMNS}, {LOADED} FROM customer_metrics",
    "weighted_mean": f"""
        SELECT production_company, CASE WHEN sum(coalesce(total_ratings, 0)) > 0
                   THEN {real(ratio("sum(coalesce(r7, 0) * coalesce(total_ratings, 0))", "sum(coalesce(total_ratings, 0))", -1), 6)}
                   ELSE {real(ratio("sum(r7)", "count(r7)", -1), 6)} END AS weighted_avg_rating
        FROM (SELECT *, r4 * 1000 + movie_id % 997 AS r7 FROM customer_bridge) GROUP BY production_company""",
    "prior_lines": """
        SELECT l_returnflag, l_orderkey, l_linenumber, CAST(lag(l_orderkey) OVER w AS DOUBLE) AS prior_orderkey,
               CAST(lag(l_quantity) OVER w AS DOUBLE) AS prior_quantity
        FROM lineitem
        WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_shipdate NULLS FIRST, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity)""",
    "prior_period": f"""
        SELECT production_company, release_year, {real("total_c", 2)} AS total_revenue, {real("w4", 4)} AS weighted_avg_rating,
               CAST(prior_year AS DOUBLE) AS prior_year, {real("prior_c", 2)} AS prior_year_revenue, {real("prior_w4", 4)} AS prior_year_rating
        FROM customer_changed""",
    "change_measures": f"""
        SELECT production_company, release_year, {real("pct_c", 2)} AS revenue_yoy_pct, {real("delta4", 4)} AS rating_yoy_delta
        FROM customer_changed""",
    "company_year_metrics": f"""
        SELECT production_company, {METRIC_COLUMNS}, {CHANGE_COLUMNS}, {LOADED} FROM company_changed""",
    "date_dimension": calendar(),
    "attribute_dimension": f"""
        SELECT movie_id, title, CAST(release_date_key AS DOUBLE) AS release_date_key, CAST(release_date AS VARCHAR) AS release_date, {BRIDGE_MONEY}, genres,
               production_countries, production_companies, spoken_languages, {LOADED}
        FROM movie_dimension""",
    "name_dimension": f"""
        SELECT md5(lower(production_company)) AS production_company_key, min(production_company) AS production_company,
               min(release_year) AS first_release_year, max(release_year) AS latest_release_year,
               {stamp("max(record_loaded_at)")} AS loaded_at
        FROM customer_bridge GROUP BY lower(production_company)""",
    "company_dimension": f"""
        SELECT md5(lower(trim(production_company))) AS production_company_key, min(trim(production_company)) AS production_company,
               min(release_year) AS first_release_year, max(release_year) AS latest_release_year,
               {stamp("max(record_loaded_at)")} AS loaded_at
        FROM bridge GROUP BY lower(trim(production_company))""",
    "rating_fact": f"""
        SELECT r.movie_id, d.title, CAST(d.release_date_key AS DOUBLE) AS release_date_key, CAST(d.release_date AS VARCHAR) AS release_date,
               CAST(year(d.release_date) AS DOUBLE) AS release_year, CAST(month(d.release_date) AS DOUBLE) AS release_month,
               d.genres, d.production_countries, {BRIDGE_MONEY},
               {real(ratio("(revenue_c - budget_c)", "budget_c", 4), 2)} AS roi_pct,
               {real("r.r4", 4)} AS avg_rating, CAST(r.total_ratings AS DOUBLE) AS total_ratings, {real("r.dev4", 4)} AS std_dev,
               {real("r.minmax6", 6)} AS avg_rating_minmax, r.zscore AS avg_rating_zscore,
               CASE WHEN r.total_ratings >= 10000 THEN 'blockbuster_signal' WHEN r.total_ratings >= 1000 THEN 'high_interest'
                    WHEN r.total_ratings >= 100 THEN 'medium_interest' ELSE 'low_interest' END AS interest_band,
               {stamp("r.loaded_at")} AS rating_loaded_at
        FROM typed_ratings r LEFT JOIN movie_dimension d USING (movie_id)""",
    "group_year_fact": fact_rows("customer_fact"),
    "company_year_fact": fact_rows("company_fact"),
    "supplier_trends": trend_rows("supplier_banded"),
    "trend_bands": trend_rows("customer_banded"),
    "company_year_trends": trend_rows("company_banded"),
    "group_summary": f"SELECT {SUMMARY_COLUMNS} FROM customer_summary",
    "dominant_category": "SELECT production_company_key, band AS dominant_band FROM customer_dominant",
    "latest_category": "SELECT production_company_key, band AS latest_band FROM customer_latest",
    "window_bound": "SELECT production_company_key, production_company, latest_year, analysis_max_year FROM customer_scored",
    "decision_score": f"SELECT production_company_key, production_company, {SCORE_COLUMNS} FROM customer_scored",
    "action_label": """
        SELECT production_company_key, production_company, action AS studio_action_recommendation FROM customer_scored""",
    "presentation_labels": f"SELECT production_company_key, production_company, {LABEL_COLUMNS} FROM customer_scored",
    "customer_scorecard": scorecard_rows("customer"),
    "company_scorecard": scorecard_rows("company"),
    "key_quality": "SELECT * FROM quality",
    "layer_counts": "SELECT * FROM layer_rows",
    "rating_coverage": "SELECT * FROM covered",
    "filter_impact": "SELECT * FROM impact",
    "audit_report": """
        SELECT 'raw_key_quality' AS section, relation || ':' || name AS metric, n AS value FROM quality
            UNPIVOT (n FOR name IN (total_rows, missing_key_rows, duplicate_key_rows))
        UNION ALL SELECT 'layer_counts', table_name || ':' || name, n FROM (
            SELECT table_name, raw_rows, staged_rows AS python_staging_rows, typed_rows AS dbt_staging_rows FROM layer_rows)
            UNPIVOT (n FOR name IN (raw_rows, python_staging_rows, dbt_staging_rows))
        UNION ALL SELECT 'layer_deltas', table_name || ':' || name, n FROM (
            SELECT table_name, raw_minus_staged AS raw_minus_python_staging,
                   staged_minus_typed AS python_staging_minus_dbt_staging FROM layer_rows)
            UNPIVOT (n FOR name IN (raw_minus_python_staging, python_staging_minus_dbt_staging))
        UNION ALL SELECT 'ratings_coverage', name, n FROM (
            SELECT universe_ids AS movie_universe_ids, kept_ids AS ratings_ids_kept,
                   missing_ids AS movie_ids_without_ratings_after_stage FROM covered)
            UNPIVOT (n FOR name IN (movie_universe_ids, ratings_ids_kept, movie_ids_without_ratings_after_stage))
        UNION ALL SELECT 'bridge_filter_impact', name, n FROM impact UNPIVOT (n FOR name IN (exploded_rows_before_filter,
            dropped_blank_company_rows, dropped_null_release_year_rows, rows_kept_by_bridge_filter))""",
    "correction_audit": f"""
        SELECT movie_id, title, release_year, production_company,
               {real("o.revenue_c", 2)} AS revenue_original, {real("b.revenue_c", 2)} AS revenue_corrected,
               {real("o.budget_c", 2)} AS budget_original, {real("b.budget_c", 2)} AS budget_corrected,
               {real(ratio("b.revenue_c", "b.budget_c", 2), 2)} AS roi_corrected, b.flag AS budget_correction_flag,
               {stamp("b.record_loaded_at")} AS record_loaded_at
        FROM bridge b JOIN (SELECT movie_id, budget_c, revenue_c FROM base) o USING (movie_id) WHERE b.flag <> 'original'""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in ("customer", "events", "lineitem", "orders", "part")
    ),
    "freshness": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {stamp(f'max({c})')} AS last_loaded,"
        f" CAST((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max({c}))) // 1000000 AS BIGINT) AS age_seconds FROM {t}"
        for t, c in (("events", "ts"), ("lineitem", "l_shipdate"), ("orders", "o_orderdate"))
    ),
    "top_k": """
        SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS release_year FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "genre_performance": f"""
        SELECT trim(genre) AS genre_name, count(DISTINCT movie_id) AS total_movies,
               {real(ratio("sum(r4)", "count(r4)", 0), 4)} AS avg_rating,
               {real(ratio("sum(revenue_c)", "100000000", 4), 4)} AS total_revenue_millions
        FROM (SELECT m.movie_id, m.revenue_c, r.r4, unnest(string_split(e.genres, ',')) AS genre
              FROM typed_core m JOIN typed_extended e USING (movie_id) LEFT JOIN typed_ratings r USING (movie_id)
              WHERE e.genres IS NOT NULL) WHERE trim(genre) <> '' GROUP BY 1""",
    "task_metrics": " UNION ALL ".join([
        task_row("ingestion", "load_ratings", ("'ratings.json'", "NULL"), "raw.ratings", LANDED_COUNTS, "NULL", "raw_ratings"),
        task_row("ingestion", "load_region", ("'region.csv'", "NULL"), "raw.region", NO_COUNTS,
                 "'columns not in the table: [''r_regionkey'']'", "(SELECT 1)", "failed"),
        task_row("staging", "build_region", ("NULL", "'raw.region'"), "staging.region", NO_COUNTS,
                 "'upstream: columns not in the table: [''r_regionkey'']'", "(SELECT 1)", "skipped"),
        *[task_row("staging", f"build_{t}", ("NULL", f"'raw.{t}'"), f"staging.{t}", STAGED_COUNTS, STAGED_TEXT, s) for t, s in (
            ("movies_main", "core_stats"), ("movie_extended", "extended_stats"), ("ratings", "ratings_stats"))],
    ]),
    "cast_losses": " UNION ALL ".join([
        losses("dirty_orders", "dirty", {"id": digits("id"), "release_date": routed("release_date"), "budget": clean("budget")}),
        losses("movies_main", "staged_core", {"id": digits("id"), "release_date": routed("release_date"),
                                              "budget": clean("budget"), "revenue": clean("revenue")}),
        losses("movie_extended", "staged_extended", {"id": digits("id")}),
        losses("ratings", "staged_ratings", {
            "movie_id": digits("movie_id"), "avg_rating": clean("avg_rating", "DECIMAL(24,12)"), "total_ratings": whole("total_ratings"),
            "stg_dev": clean("stg_dev", "DECIMAL(10,4)"), "loaded_at": "TRY_CAST(substr(loaded_at, 1, 19) AS TIMESTAMP)"}),
    ]),
    "build_log_tasks": f"""
        SELECT run_id, 'marts' AS stage_name, task AS task_name, 'models/' || task || '.sql' AS source_file,
               CASE task WHEN 'a' THEN 'db.raw.z, db.staging.up' ELSE 'db.marts.a' END AS source_relation,
               CASE task WHEN 'a' THEN 'db.marts.a' ELSE 'db.marts.b_alias' END AS target_relation,
               status, CAST(rows_out AS DOUBLE) AS rows_out, CASE WHEN status = 'failed' THEN 'event ' || event_type END AS error_message,
               {stamp("ts + INTERVAL 8 HOUR")} AS started_at, {stamp("ts")} AS finished_at,
               CAST(CASE WHEN half % 2 = 0 THEN half // 2 WHEN (half // 2) % 2 = 0 THEN half // 2 ELSE half // 2 + 1 END
                    AS INTEGER) AS duration_seconds, run_status
        FROM (SELECT 'run-' || event_id AS run_id, event_type, ts, CAST(floor(value) AS BIGINT) AS half, 'a' AS task,
                     'completed' AS status, user_id AS rows_out,
                     CASE WHEN event_type = 'error' THEN 'partial' ELSE 'completed' END AS run_status FROM events
              UNION ALL
              SELECT 'run-' || event_id, event_type, ts, CAST(floor(value) AS BIGINT), 'b',
                     CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'completed' END,
                     CASE WHEN event_id % 5 = 0 THEN 12 END,
                     CASE WHEN event_type = 'error' THEN 'partial' ELSE 'completed' END FROM events)""",
    "check_not_null": " UNION ALL ".join(nulls("customer_bridge", "customer_bridge", {
        "movie_id": "movie_id", "revenue_amount": "revenue_c", "avg_rating": "r4", "total_ratings": "total_ratings"})),
    "check_unique": " UNION ALL ".join([
        repeats("lineitem", "lineitem", "l_orderkey", "l_orderkey"), repeats("orders", "orders", "o_orderkey", "o_orderkey")]),
    "check_accepted_values": " UNION ALL ".join([
        violations("amounts", "budget_correction_flag", "accepted_values", "SELECT 0"),
        violations("events", "event_type", "accepted_values",
                   "SELECT count(DISTINCT event_type) FROM events WHERE event_type NOT IN ('click', 'view', 'signup')")]),
    "check_relationships": " UNION ALL ".join([
        violations("lineitem", "l_orderkey", "relationships",
                   "SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
        violations("orders", "o_orderkey", "relationships",
                   "SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")]),
    "declared_checks": declared(),
}

ORACLES: dict[str, str] = {name: statement(final) for name, final in FINALS.items()}
