"""DuckDB SQL with the same results as the registered queries, written independently."""

import re

from textloom.functions.sequences import END_ID, PAD_ID, RESERVED_IDS, START_ID, UNKNOWN_ID
from textloom.functions.stopwords import ENGLISH_STOP_WORDS
from textloom.operators.clean import split_bound
from textloom.plans.corpus import CATEGORIES
from textloom.plans.queries import BATCH_SIZE, SAMPLE_FRACTION, SEQUENCE_LENGTH, SHARDS
from textloom.sources.articles import NA_TOKENS


def _strings(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


URL = r"^(https?://|www\.)|^[\p{L}\p{N}.-]+\.(com|org|net|edu|gov|io)(/|$)"
CLITIC = r"('s|n't|'re|'ve|'ll|'d|'m)$".replace("'", "''")
STOPS = f"[{_strings(ENGLISH_STOP_WORDS)}]"
FACTORS = [f"c{i}" for i in range(8)]


def _null_if_na(e: str) -> str:
    return f"CASE WHEN {e} NOT IN ({_strings(NA_TOKENS)}) THEN {e} END"


def _words(text: str, urls: bool) -> str:
    kept = f"string_split_regex({text}, '\\s+')"
    if not urls:
        kept = f"list_filter({kept}, lambda x: NOT regexp_matches(x, '{URL}'))"
    split = rf"string_split_regex(regexp_replace(x, '{CLITIC}', ''), '[^\p{{L}}\p{{N}}]+')"
    flat = f"flatten(list_transform({kept}, lambda x: {split}))"
    return rf"list_filter({flat}, lambda x: regexp_matches(x, '^\p{{L}}+$'))"


LOW = "lower(replace(text, '’', ''''))"
PLAIN = rf"list_filter(string_split_regex({LOW}, '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
SPLIT = f"CASE WHEN substr(md5(text || '|42'), 1, 4) < '{split_bound(0.8)}' THEN 'train' ELSE 'test' END"
NO_STOPS = f"list_filter(words, lambda x: NOT list_contains({STOPS}, x))"


def _bag(tokens: str, source: str, keys: str = "id, category") -> str:
    return f"""SELECT {keys}, term, count(*) AS tf
        FROM (SELECT {keys}, unnest({tokens}) AS term FROM {source}) GROUP BY ALL"""


def _weights(bag: str) -> str:
    return f"""SELECT id, category, term, term_id,
            w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight
        FROM (SELECT b.id, b.category, v.term, v.term_id, b.tf * v.idf AS w
              FROM {bag} b JOIN vocab v USING (term))"""


def _report(preds: str) -> str:
    return f"""SELECT class, CASE WHEN np = 0 THEN 0 ELSE hit / np END AS precision,
            CASE WHEN ny = 0 THEN 0 ELSE hit / ny END AS recall,
            CASE WHEN hit = 0 THEN 0 ELSE 2 * hit / (np + ny) END AS f1, ny AS support
        FROM (SELECT class, (SELECT count(*) FROM {preds} WHERE y = class AND p = class) AS hit,
                     (SELECT count(*) FROM {preds} WHERE p = class) AS np,
                     (SELECT count(*) FROM {preds} WHERE y = class) AS ny
              FROM (SELECT y AS class FROM {preds} UNION SELECT p FROM {preds}))"""


def _start(key: str, a: int, b: int) -> str:
    return ", ".join(f"0.1 + (({key} * {a} + {i * b}) % 10) / 10.0 AS c{i}" for i in range(8))


def _gram(table: str) -> str:
    return ", ".join(
        f"(SELECT sum(c{i} * c{j}) FROM {table}) AS g{i}_{j}" for i in range(8) for j in range(8)
    )


def _update(key: str, old: str, product: str, gram: str) -> str:
    cells = []
    for j in range(8):
        below = " + ".join(f"o.c{i} * g.g{i}_{j}" for i in range(8))
        cells.append(f"o.c{j} * b.c{j} / greatest({below}, 1e-12) AS c{j}")
    return f"SELECT o.{key}, {', '.join(cells)} FROM {old} o JOIN {product} b USING ({key}), {gram} g"


def _product(key: str, table: str, on: str) -> str:
    sums = ", ".join(f"sum(x.weight * t.c{i}) AS c{i}" for i in range(8))
    return f"SELECT x.{key}, {sums} FROM tfidf_train x JOIN {table} t USING ({on}) GROUP BY x.{key}"


def _psi(x: str) -> str:
    """The digamma function: its recurrence eight times, then the asymptotic series."""
    y = f"({x} + 8)"
    below = " + ".join(f"1.0 / ({x} + {i})" for i in range(8))
    series = f"1.0/12/{y}**2 - 1.0/120/{y}**4 + 1.0/252/{y}**6 - 1.0/240/{y}**8 + 1.0/132/{y}**10"
    return f"(ln({y}) - 0.5 / {y} - ({series}) - ({below}))"


CTES = {
    "arts": f"""SELECT doc_id AS id, lang AS category, source AS subcategory,
            {_null_if_na("split_part(text, chr(10), 1)")} AS title,
            {_null_if_na("CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END")} AS abstract
        FROM documents""",
    "complete": """SELECT id, category, title || abstract AS text FROM arts
        WHERE title IS NOT NULL AND abstract IS NOT NULL AND category IS NOT NULL""",
    "work": f"SELECT * FROM complete WHERE category IN ({_strings(CATEGORIES)})",
    "worded": f"SELECT id, category, text, {SPLIT} AS split, {_words(LOW, False)} AS words FROM work",
    "toks": f"SELECT id, category, split, {NO_STOPS} AS tokens FROM worded",
    "bag": _bag("tokens", "toks", "id, category, split"),
    "bag_train": "SELECT * FROM bag WHERE split = 'train'",
    "bag_test": "SELECT * FROM bag WHERE split = 'test'",
    "vocab": """SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS term_id,
            ln((1.0 + (SELECT count(*) FROM toks WHERE split = 'train')) / (1.0 + df)) + 1 AS idf
        FROM (SELECT term, count(*) AS df FROM bag_train GROUP BY term HAVING count(*) >= 2)""",
    "tfidf_train": _weights("bag_train"),
    "tfidf_test": _weights("bag_test"),
    "raw": rf"""SELECT id, category,
            regexp_extract_all({LOW}, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}\s]+') AS tokens FROM work""",
    "plain": f"SELECT id, category, {SPLIT} AS split, {PLAIN} AS tokens FROM work",
    "marked": f"""SELECT id, {SPLIT} AS split, category AS y,
            CASE WHEN lower(text) LIKE '% the %' THEN 'en' WHEN lower(text) LIKE '% le %' THEN 'fr'
                 WHEN lower(text) LIKE '% el %' THEN 'es' ELSE 'de' END AS p FROM work""",
    "constant": f"SELECT id, y, '{CATEGORIES[0]}' AS p FROM marked",
    "report_markers": _report("marked"),
    "report_constant": _report("constant"),
    "comparison": """SELECT 'markers' AS model,
            round((SELECT avg(CASE WHEN y = p THEN 1.0 ELSE 0 END) FROM marked), 6) AS accuracy,
            round((SELECT avg(f1) FROM report_markers), 6) AS f1_macro
        UNION ALL SELECT 'constant',
            round((SELECT avg(CASE WHEN y = p THEN 1.0 ELSE 0 END) FROM constant), 6),
            round((SELECT avg(f1) FROM report_constant), 6)""",
    "codes": f"""SELECT category, row_number() OVER (ORDER BY category) - 1 AS code
        FROM (SELECT DISTINCT category FROM complete WHERE {SPLIT} = 'train')""",
    "plain_codes": """SELECT category, row_number() OVER (ORDER BY category) - 1 AS code
        FROM (SELECT DISTINCT category FROM plain WHERE split = 'train')""",
    "plain_vocab": f"""SELECT term, row_number() OVER (ORDER BY term) - 1 + {RESERVED_IDS} AS word_id
        FROM (SELECT term FROM ({_bag("tokens", "plain", "id, split")}) WHERE split = 'train'
              GROUP BY term HAVING count(*) >= 2)""",
    "placed": f"""SELECT id, unnest(tokens[1:{SEQUENCE_LENGTH - 2}]) AS term,
            unnest(range(1, 1 + len(tokens[1:{SEQUENCE_LENGTH - 2}]))) AS pos FROM plain""",
    "ids": f"""SELECT p.id, any_value(c.code) AS label, coalesce(any_value(s.ids), []) AS ids
        FROM plain p JOIN plain_codes c USING (category) LEFT JOIN (
            SELECT id, list(coalesce(word_id, {UNKNOWN_ID}) ORDER BY pos) AS ids
            FROM placed LEFT JOIN plain_vocab USING (term) GROUP BY id) s USING (id)
        GROUP BY p.id""",
    "encoded": f"""SELECT id, label, list_concat([{START_ID}], ids, [{END_ID}],
            list_transform(range({SEQUENCE_LENGTH} - 2 - len(ids)), lambda i: {PAD_ID})) AS ids FROM ids""",
    "raw_bag": _bag("tokens", "raw"),
    "raw_ranked": """SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) - 1 AS rank
        FROM raw_bag GROUP BY term HAVING count(*) >= 2""",
    "ranked": "SELECT term, row_number() OVER (ORDER BY df DESC, term) - 1 AS rank FROM vocab",
    "plain_bag": _bag("tokens", "plain", "id, split"),
    "plain_ranked": """SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) - 1 AS rank
        FROM plain_bag WHERE split = 'train' GROUP BY term HAVING count(*) >= 2""",
    "words_in": f"""SELECT id, label, split, unnest(ids) AS word_id FROM ids JOIN (SELECT id, split FROM plain) USING (id)""",
    "bayes_n": f"""SELECT label, word_id, count(*) AS n FROM words_in
        WHERE split = 'train' AND word_id >= {RESERVED_IDS} GROUP BY ALL""",
    "bayes_label": """SELECT label, ln(count(*) / sum(count(*)) OVER ()) AS prior,
            coalesce((SELECT sum(n) FROM bayes_n WHERE bayes_n.label = i.label), 0)
                + (SELECT count(*) FROM plain_vocab) AS total
        FROM ids i JOIN plain USING (id) WHERE split = 'train' GROUP BY label""",
    "bayes_joint": f"""SELECT i.id, i.label, b.label AS predicted, b.prior + coalesce(sum(
                CASE WHEN w.word_id >= {RESERVED_IDS} THEN ln((coalesce(n.n, 0) + 1) / b.total) END), 0) AS score
        FROM (SELECT id, label FROM ids JOIN plain USING (id) WHERE split = 'test') i CROSS JOIN bayes_label b
        LEFT JOIN words_in w ON w.id = i.id LEFT JOIN bayes_n n ON n.word_id = w.word_id AND n.label = b.label
        GROUP BY i.id, i.label, b.label, b.prior, b.total""",
    "lda_b": f"""SELECT term_id, t, exp({_psi("v")} - {_psi("sum(v) OVER (PARTITION BY t)")}) AS e FROM (
            SELECT term_id, t, 0.1 + ((term_id * 11 + t * 5) % 10) / 10.0::DOUBLE AS v
            FROM vocab CROSS JOIN (SELECT unnest(range(8)) AS t))""",
    "lda_x": "SELECT id, category, term_id, tf FROM bag_train JOIN vocab USING (term)",
    "lda_gamma": f"""SELECT id, t, 1.0 / 8 + sum(tf * e / total) AS g FROM (
            SELECT id, t, tf, e, sum(e) OVER (PARTITION BY id, term_id) AS total
            FROM lda_x JOIN lda_b USING (term_id)) GROUP BY id, t""",
    "lda_theta": f"""SELECT id, t, g, {_psi("g")} - {_psi("sum(g) OVER (PARTITION BY id)")} AS logs FROM lda_gamma""",
    "lda_phi": """SELECT id, term_id, t, tf, exp(logs) * e AS part,
            sum(exp(logs) * e) OVER (PARTITION BY id, term_id) AS total
        FROM lda_x JOIN lda_b USING (term_id) JOIN lda_theta USING (id, t)""",
    "emb": """SELECT vec_id, unnest(embedding)::DOUBLE AS v,
            unnest(range(len(embedding))) AS dim FROM embeddings""",
    "w0": f"SELECT id, {_start('id', 7, 3)} FROM (SELECT DISTINCT id FROM tfidf_train)",
    "h0": f"SELECT term_id, {_start('term_id', 11, 5)} FROM vocab",
    "h0_gram": f"SELECT {_gram('h0')}",
    "w1": _update("id", "w0", f"({_product('id', 'h0', 'term_id')})", "h0_gram"),
    "w1_gram": f"SELECT {_gram('w1')}",
    "h1": _update("term_id", "h0", f"({_product('term_id', 'w1', 'id')})", "w1_gram"),
}
STORED = {"lda_b", "lda_x", "lda_theta", "lda_phi", "plain_bag", "words_in", "bayes_n", "worded", "toks", "bag", "vocab", "tfidf_train", "w1", "h0", "plain", "raw_bag", "marked",
          "report_markers", "report_constant"}


def _with(final: str) -> str:
    """The statement with the common tables that it needs, in order of definition."""
    needed, queue = set(), [final]
    while queue:
        text = queue.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                queue.append(CTES[name])
    parts = [
        f"{n} AS {'MATERIALIZED ' if n in STORED else ''}({body})"
        for n, body in CTES.items()
        if n in needed
    ]
    return f"WITH {', '.join(parts)} {final}" if parts else final


def _top_words(weights: str) -> str:
    return f"""SELECT category, rank, term, weight FROM (
        SELECT *, row_number() OVER (PARTITION BY category ORDER BY weight DESC, term) AS rank
        FROM (SELECT category, term, round(sum(weight), 6) AS weight FROM {weights}
              GROUP BY category, term)) WHERE rank <= 10"""


def _nulls(stage: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null FROM {source}"
        for c in ("title", "abstract", "category")
    )


_WHOLE = "(SELECT * FROM arts WHERE title IS NOT NULL AND abstract IS NOT NULL AND category IS NOT NULL)"
_SHUFFLED = "row_number() OVER (ORDER BY md5(id::VARCHAR || '|42'), id) - 1"
_ROUND8 = ", ".join(f"round({c}, 6) AS {c}" for c in FACTORS)
_DIM = "(SELECT any_value(len(embedding)) FROM embeddings)"

_FINAL = {
    "null_profile": _nulls("loaded", "arts") + " UNION ALL " + _nulls("complete", _WHOLE),
    "project_columns": "SELECT id, title, category FROM arts",
    "clean_merge_text": "SELECT id, category, text FROM complete",
    "category_filter": f"SELECT id, category, subcategory FROM arts WHERE category IN ({_strings(CATEGORIES)})",
    "funnel_shape": """SELECT 'loaded' AS step, count(*) AS n_rows FROM arts
        UNION ALL SELECT 'complete', count(*) FROM complete UNION ALL SELECT 'chosen', count(*) FROM work""",
    "table_shape": "SELECT count(*) AS n_rows, 3::BIGINT AS n_columns FROM complete",
    "preview_rows": "SELECT id, category, text FROM complete ORDER BY id LIMIT 10",
    "distinct_labels": "SELECT count(DISTINCT category) AS n_distinct FROM arts",
    "category_counts": "SELECT category, count(*) AS n FROM arts WHERE category IS NOT NULL GROUP BY category",
    "category_members": f"SELECT category, {_SHUFFLED} AS row_index, id FROM work",
    "exact_sample": f"""SELECT id, category FROM (SELECT *, {_SHUFFLED} AS i FROM work)
        WHERE i < (SELECT round_even({SAMPLE_FRACTION} * count(*), 0) FROM work)""",
    "row_index": f"SELECT id, category, {_SHUFFLED} AS row_index FROM arts",
    "md5_split": f"SELECT id, {SPLIT} AS split FROM complete",
    "tokenize_texts": "SELECT id, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM toks",
    "stopword_filter": f"SELECT id, len(words) AS n_words, len({NO_STOPS}) AS n_kept FROM worded",
    "raw_token_list": "SELECT id, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM raw",
    "alphanumeric_words": "SELECT id, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM plain",
    "url_tokens": f"""SELECT page_id,
        len({NO_STOPS.replace("words", _words(LOW, True), 1)}) - len({NO_STOPS.replace("words", _words(LOW, False), 1)}) AS n_url_words
        FROM (SELECT page_id, url || ' ' || html AS text FROM pages)""",
    "lemma_lookup": """SELECT t.id, coalesce(any_value(j.tokens), '') AS tokens FROM toks t LEFT JOIN (
        SELECT id, string_agg(coalesce(l.lemma, u.word), ' ' ORDER BY u.pos) AS tokens
        FROM (SELECT id, unnest(tokens) AS word, unnest(range(len(tokens))) AS pos FROM toks) u
        LEFT JOIN (SELECT a.term AS surface, b.term AS lemma FROM (SELECT DISTINCT term FROM bag) a
                   JOIN (SELECT DISTINCT term FROM bag) b ON a.term = b.term || 's') l
        ON u.word = l.surface GROUP BY id) j USING (id) GROUP BY t.id""",
    "lemma_counts": """SELECT id, coalesce(l.lemma, u.word) AS term, count(*) AS tf
        FROM (SELECT id, unnest(tokens) AS word FROM toks) u
        LEFT JOIN (SELECT a.term AS surface, b.term AS lemma FROM (SELECT DISTINCT term FROM bag) a
                   JOIN (SELECT DISTINCT term FROM bag) b ON a.term = b.term || 's') l
        ON u.word = l.surface GROUP BY ALL""",
    "vocabulary": "SELECT term, term_id, df, round(idf, 6) AS idf FROM vocab",
    "term_counts": "SELECT id, term, tf FROM bag_train JOIN vocab USING (term)",
    "tfidf": "SELECT id, term, round(weight, 6) AS weight FROM tfidf_train",
    "tfidf_holdout": "SELECT id, term, round(weight, 6) AS weight FROM tfidf_test",
    "counts_holdout": """SELECT t.id, count(k.term) AS n_terms, coalesce(sum(k.tf), 0)::BIGINT AS n_tokens
        FROM toks t LEFT JOIN (SELECT b.id, b.term, b.tf FROM bag_test b JOIN vocab USING (term)) k USING (id)
        WHERE t.split = 'test' GROUP BY t.id""",
    "matrix_shape": """SELECT s.split, n_docs, n_terms, n_nonzero, round(n_nonzero / (n_docs * n_terms), 9) AS density
        FROM (SELECT split, count(*) AS n_docs FROM toks GROUP BY split) s
        JOIN (SELECT split, count(*) AS n_nonzero FROM bag JOIN vocab USING (term) GROUP BY split) b USING (split),
             (SELECT count(*) AS n_terms FROM vocab)""",
    "top_words_count": _top_words(
        "(SELECT category, term, tf::DOUBLE AS weight FROM bag_train JOIN vocab USING (term))"
    ),
    "top_words_tfidf": _top_words("tfidf_train"),
    "word_vector_lookup": f"""SELECT v.term, {_DIM} AS dim, round(coalesce(t, 0), 6) AS total,
            round(coalesce(p, 0), 6) AS position_weighted_total, round(coalesce(s, 0), 6) AS squared_norm
        FROM vocab v LEFT JOIN (SELECT term, sum(v) AS t, sum(v * (dim + 1)) AS p, sum(v * v) AS s
            FROM ranked JOIN emb ON rank = vec_id GROUP BY term) USING (term)""",
    "document_mean_vector": f"""SELECT n.id, d.dim, round(coalesce(s.total, 0) / n.n, 6) AS mean
        FROM (SELECT id, sum(tf) AS n FROM raw_bag GROUP BY id) n
        CROSS JOIN (SELECT unnest(range({_DIM})) AS dim) d
        LEFT JOIN (SELECT b.id, e.dim, sum(b.tf * e.v) AS total FROM raw_bag b
                   JOIN raw_ranked r USING (term) JOIN emb e ON r.rank = e.vec_id GROUP BY b.id, e.dim) s
        ON s.id = n.id AND s.dim = d.dim""",
    "docvec_features": f"""SELECT n.id, n.split, n.category, d.dim, round(coalesce(s.total / n.n, 0), 6) AS value
        FROM (SELECT id, split, category, len(tokens) AS n FROM plain) n
        CROSS JOIN (SELECT unnest(range({_DIM})) AS dim) d
        LEFT JOIN (SELECT b.id, e.dim, sum(b.tf * e.v) AS total FROM plain_bag b
                   JOIN plain_ranked r USING (term) JOIN emb e ON r.rank = e.vec_id GROUP BY b.id, e.dim) s
        ON s.id = n.id AND s.dim = d.dim""",
    "sequence_bayes": """SELECT id, label, predicted, round(score, 6) AS score FROM bayes_joint
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, predicted) = 1""",
    "mean_vector": """SELECT label, dim, round(avg(v), 6) AS mean
        FROM (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS dim FROM embeddings)
        GROUP BY label, dim""",
    "label_encode": f"SELECT id, category, code FROM complete JOIN codes USING (category) WHERE {SPLIT} = 'test'",
    "label_decode": f"SELECT id, code, category FROM complete JOIN codes USING (category) WHERE {SPLIT} = 'test'",
    "unseen_labels": f"""SELECT category, count(*) AS n_rows FROM complete WHERE {SPLIT} = 'test'
        AND category NOT IN (SELECT category FROM work WHERE {SPLIT} = 'train') GROUP BY category""",
    "accuracy_by_split": "SELECT split, round(avg(CASE WHEN y = p THEN 1.0 ELSE 0 END), 6) AS accuracy FROM marked GROUP BY split",
    "confusion_matrix": "SELECT y, "
    + ", ".join(f"count(*) FILTER (p = '{c}') AS {c}" for c in [*CATEGORIES, "de"])
    + " FROM marked GROUP BY y",
    "class_report": """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
            round(f1, 6) AS f1, support FROM report_markers
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
            sum(support)::BIGINT FROM report_markers
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
            round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
            sum(support)::BIGINT FROM report_markers""",
    "macro_f1": "SELECT round(avg(f1), 6) AS f1_macro FROM report_markers",
    "model_comparison": "SELECT model, accuracy, f1_macro FROM comparison",
    "best_model": "SELECT model, f1_macro FROM comparison ORDER BY f1_macro DESC, model LIMIT 1",
    "challenger_gate": """SELECT b.model AS incumbent, c.model AS challenger, c.f1_macro AS challenger_value,
            b.f1_macro AS incumbent_value, c.f1_macro > b.f1_macro AS promote
        FROM comparison c JOIN comparison b ON b.model = 'constant' AND c.model <> 'constant'""",
    "argmax_logits": "SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS prediction FROM embeddings",
    "encode_sequence": "SELECT id, array_to_string(ids, ' ') AS input_ids, label FROM encoded",
    "attention_mask": """SELECT id, array_to_string(list_transform(ids, lambda i: least(1, i)), ' ') AS attention_mask,
        array_to_string(list_transform(ids, lambda i: 0), ' ') AS token_type_ids FROM encoded""",
    "family_inputs": """SELECT id, array_to_string(ids, ' ') AS input_ids,
        array_to_string(list_transform(ids, lambda i: least(1, i)), ' ') AS attention_mask, label FROM encoded""",
    "batch_assign": f"""SELECT id, (row_number() OVER (ORDER BY id) - 1) // {BATCH_SIZE} AS in_order,
        ({_SHUFFLED}) // {BATCH_SIZE} AS shuffled FROM complete""",
    "shard_assign": f"SELECT id, ({_SHUFFLED}) % {SHARDS} AS shard FROM complete",
    "nmf_one_step": f"""SELECT 'document' AS side, id AS key, {_ROUND8} FROM w1
        UNION ALL SELECT 'term', term_id, {_ROUND8} FROM h1""",
    "lda_one_step": """SELECT t::INTEGER AS topic, term_id, round(1.0 / 8 + sum(tf * part / total), 6) AS weight
        FROM lda_phi GROUP BY t, term_id""",
    "lda_document_bounds": """SELECT d.id, d.category, """
    + ", ".join(f"round(coalesce(c{i}, 1.0 / 8), 6) AS c{i}" for i in range(8))
    + """, round(coalesce(words + rest, 0), 6) AS bound
        FROM (SELECT id, category FROM toks WHERE split = 'train') d
        LEFT JOIN (SELECT id, sum(tf * ln(total)) AS words FROM lda_phi WHERE t = 0 GROUP BY id) w USING (id)
        LEFT JOIN (SELECT id, sum((1.0 / 8 - g) * logs) + sum(lgamma(g)) - lgamma(sum(g)) + lgamma(1) - 8 * lgamma(1.0 / 8) AS rest,
            """
    + ", ".join(f"sum(g) FILTER (t = {i}) / sum(g) AS c{i}" for i in range(8))
    + """ FROM lda_theta GROUP BY id) r USING (id)""",
    "tsv_scan": "SELECT id, category, title, abstract FROM arts",
    "tsv_splits": f"""SELECT split, category, count(*) AS n
        FROM (SELECT category, {SPLIT.replace("text", "coalesce(title, '')")} AS split FROM arts) GROUP BY ALL""",
    "entity_rows": """SELECT id, e.label AS label, e.type AS type, 'Q' || length(e.label) AS wikidata_id,
            CASE WHEN e.label IS NOT NULL THEN 1.0::DOUBLE END AS confidence,
            (strpos(title, e.label) - 1)::VARCHAR AS occurrence_offsets,
            e.label || ' ' || upper(e.label) AS surface_forms
        FROM (SELECT id, title, unnest(CASE WHEN len(w) > 0
                THEN [{'label': w[1], 'type': 'F'}, {'label': w[-1], 'type': 'L'}]
                ELSE [{'label': NULL, 'type': NULL}] END) AS e
              FROM (SELECT id, title, list_filter(string_split_regex(title, '[^A-Za-z]+'), lambda x: x <> '') AS w FROM arts))""",
    "nmf_holdout_optimality": "SELECT id, true AS optimal FROM toks WHERE split = 'test'",
    "stream_redelivered": """SELECT id, 1::BIGINT AS times, 0::BIGINT AS differs FROM arts
        WHERE title IS NOT NULL AND abstract IS NOT NULL""",
    "saved_factors": """SELECT model, id, 0::BIGINT AS differs FROM toks
        CROSS JOIN (VALUES ('lda'), ('nmf')) AS m(model) WHERE split = 'test'""",
    "daily_arrivals": "SELECT id, category, title, abstract FROM arts",
}

ORACLES = {name: _with(final) for name, final in _FINAL.items()}
