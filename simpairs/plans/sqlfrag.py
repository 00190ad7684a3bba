"""Plain-SQL (DuckDB dialect) fragments used by the oracle queries.

They restate the operators' definitions in the most direct SQL form (global windows,
self-joins, recursive CTEs) so that the Spark plans can be checked against them.
"""
from __future__ import annotations

# Same character classes as simpairs.functions.text
WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]+"
BAD = r"[^\p{L}\p{N}_ .,;:()\[\]{}]"
SEED = 42


def clean(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({x}), '{WS}', ' ', 'g'), '{BAD}', '', 'g'))"


def tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, ' +'), lambda t: t <> '')"


def h(tag: str, key: str, seed: int = SEED) -> str:
    return f"('0x' || substr(md5('{seed}:{tag}:' || CAST({key} AS VARCHAR)), 1, 15))::BIGINT"


def r6(x: str) -> str:
    """Same IEEE steps as the Spark side: floor(x * 1e6 + 0.5) / 1e6."""
    return (f"(CASE WHEN abs(CAST({x} AS DOUBLE)) < 1e12 THEN floor(CAST({x} AS DOUBLE) * 1000000.0::DOUBLE + 0.5::DOUBLE)"
            f" / 1000000.0::DOUBLE ELSE CAST({x} AS DOUBLE) END)")


def rewrite_round6(sql: str) -> str:
    """Replace every `round(expr, 6)` by r6(expr) (parenthesis-aware)."""
    out, i = [], 0
    while True:
        k = sql.find("round(", i)
        if k < 0 or (k > 0 and (sql[k - 1].isalnum() or sql[k - 1] == "_")):
            if k < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:k + 6])
            i = k + 6
            continue
        depth, j, comma = 0, k + 5, -1
        while j < len(sql):
            ch = sql[j]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
                if depth == 0:
                    break
            elif ch == "," and depth == 1:
                comma = j
            j += 1
        inner, digits = sql[k + 6:comma], sql[comma + 1:j].strip()
        if comma < 0 or digits != "6":
            out.append(sql[i:k + 6])
            i = k + 6
            continue
        out.append(sql[i:k])
        out.append(r6(rewrite_round6(inner)))
        i = j + 1


def clauses_cte(category_expr: str = "lang", name: str = "c") -> str:
    return (f"{name} AS (SELECT CAST({category_expr} AS VARCHAR) AS category, doc_id AS clause_id, "
            f"{clean('coalesce(text, ' + chr(39) + 'nan' + chr(39) + ')')} AS clause FROM documents)")


def tokens_cte(src: str = "c", name: str = "t") -> str:
    return (f"{name} AS (SELECT category, clause_id, unnest(tk) AS word, generate_subscripts(tk, 1) - 1 AS pos "
            f"FROM (SELECT category, clause_id, {tokens('clause')} AS tk FROM {src}))")


def vocab_ctes(src: str = "c", min_freq: int = 2) -> str:
    """CTEs t, wc, vocab(word, idx)."""
    return (
        tokens_cte(src, "t") + ",\n"
        "wc AS (SELECT word, count(*) AS cnt, min({'category': category, 'clause_id': clause_id, 'pos': pos}) AS f "
        "FROM t GROUP BY word),\n"
        f"vocab AS (SELECT word, CAST(row_number() OVER (ORDER BY f.category, f.clause_id, f.pos) + 3 AS INTEGER) AS idx "
        f"FROM wc WHERE cnt >= {min_freq} "
        "UNION ALL SELECT * FROM (VALUES ('<PAD>', 0), ('<UNK>', 1), ('<START>', 2), ('<END>', 3)) v(word, idx))"
    )


def encode_cte(src: str, vocab: str = "vocab", name: str = "enc", max_len: int | None = 128,
               id_col: str = "clause_id", text_col: str = "clause") -> str:
    """(id, seq INTEGER[]) with UNK=1 and optional pad/truncate."""
    lim = f"WHERE pos < {max_len}" if max_len is not None else ""
    pad = (f"CASE WHEN len(s) >= {max_len} THEN s[1:{max_len}] "
           f"ELSE list_concat(s, list_transform(range({max_len} - len(s)), lambda x: 0)) END"
           if max_len is not None else "s")
    return (
        f"{name}_t AS (SELECT {id_col} AS id, unnest(tk) AS word, generate_subscripts(tk, 1) - 1 AS pos "
        f"FROM (SELECT {id_col}, {tokens(text_col)} AS tk FROM {src})),\n"
        f"{name}_j AS (SELECT t.id, t.pos, coalesce(v.idx, 1) AS idx FROM {name}_t t LEFT JOIN {vocab} v "
        f"ON t.word = v.word {lim}),\n"
        f"{name}_g AS (SELECT s0.{id_col} AS id, coalesce(g.s, []::INTEGER[]) AS s FROM {src} s0 LEFT JOIN "
        f"(SELECT id, list(idx ORDER BY pos) AS s FROM {name}_j GROUP BY id) g ON g.id = s0.{id_col}),\n"
        f"{name} AS (SELECT id AS {id_col}, CAST({pad} AS INTEGER[]) AS seq FROM {name}_g)"
    )


def render(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda v: CAST(v AS VARCHAR)), ' ')"
