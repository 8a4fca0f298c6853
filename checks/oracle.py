"""The same results in plain SQL over the source files, written apart from the engine.

Each statement is a chain of WITH parts; ``statement`` adds the parts a query needs.
"""

from __future__ import annotations

import re

# Source tables from the retail files.
ITEMS = """
SELECT l_orderkey, MIN(l_suppkey) AS sk, MIN(l_partkey) AS pk, MAX(l_shipdate) AS fim
FROM lineitem GROUP BY l_orderkey
"""


def parent(table: str, key: str = "event_id") -> str:
    """A parent's id: each fourth the first one, the others spread over all, a share beyond the last."""
    return (
        f"CAST(CASE WHEN ({key})%4=0 THEN 1 ELSE ({key}) % (SELECT COUNT(*) + COUNT(*)//16 + 1 FROM {table}) + 1 END "
        "AS BIGINT)"
    )


SOURCES = {
    "plataformas": "SELECT CAST(r_regionkey+1 AS BIGINT) AS id_plataforma, r_name AS nome FROM region",
    "jogos": """
        SELECT CAST(p_partkey+1 AS BIGINT) AS id_jogo, p_name AS nome, p_brand AS desenvolvedor,
               CAST(2000+p_size%25 AS INT) AS ano_lancamento, p_partkey%10<>0 AS ativo FROM part""",
    "streamers": """
        SELECT CAST(s_suppkey+1 AS BIGINT) AS id_streamer, s_name AS nome, n_name AS pais,
               DATE '1995-01-01'+CAST(s_suppkey%365 AS INT) AS data_cadastro,
               CAST(n_regionkey+1 AS BIGINT) AS id_plataforma
        FROM supplier JOIN nation ON n_nationkey=s_nationkey""",
    "viewers": """
        SELECT CAST(c_custkey+1 AS BIGINT) AS id_viewer, c_name AS nome, n_name AS pais,
               DATE '1995-01-01'+CAST(c_custkey%365 AS INT) AS data_cadastro
        FROM customer JOIN nation ON n_nationkey=c_nationkey""",
    "emotes": f"""
        SELECT CAST(event_id+1 AS BIGINT) AS id_emote, event_type AS nome,
               {parent("supplier")} AS id_streamer,
               CASE event_id%3 WHEN 0 THEN ' Gratis ' WHEN 1 THEN 'assinante' ELSE 'vip' END AS disponivel_para
        FROM events WHERE event_type='error'""",
    "transmissoes": """
        SELECT CAST(o_orderkey+1 AS BIGINT) AS id_transmissao, CAST(sk+1 AS BIGINT) AS id_streamer,
               CAST(pk+1 AS BIGINT) AS id_jogo, o_orderdate AS data_inicio, fim AS data_fim,
               CAST(FLOOR(o_totalprice) AS INT) AS pico_viewers
        FROM orders LEFT JOIN items l ON l.l_orderkey=o_orderkey""",
    "visualizacoes": """
        SELECT CAST(l_orderkey*8+l_linenumber AS BIGINT) AS id_visualizacao, CAST(o_custkey+1 AS BIGINT) AS id_viewer,
               CAST(l_orderkey+1 AS BIGINT) AS id_transmissao, CAST(FLOOR(l_quantity) AS INT) AS minutos_assistidos,
               l_shipdate AS data_hora
        FROM lineitem JOIN orders ON o_orderkey=l_orderkey""",
    "follows": f"""
        SELECT CAST(event_id+1 AS BIGINT) AS id_follow, CAST(user_id+1 AS BIGINT) AS id_viewer,
               {parent("supplier")} AS id_streamer, CAST(ts AS DATE) AS data_follow,
               CASE WHEN event_id%5=0 THEN CAST(ts AS DATE)+CAST(event_id%9-2 AS INT) END AS data_unfollow
        FROM events WHERE event_type='signup'""",
    "assinaturas": """
        SELECT CAST(o_orderkey+1 AS BIGINT) AS id_assinatura, CAST(o_custkey+1 AS BIGINT) AS id_viewer,
               CAST(sk+1 AS BIGINT) AS id_streamer,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'tier3' WHEN '2-HIGH' THEN ' TIER2 '
                    WHEN '3-MEDIUM' THEN 'tier1' WHEN '5-LOW' THEN 'gratis' ELSE 'none' END AS tipo,
               CAST(o_orderdate AS DATE) AS data_inicio,
               CASE o_orderstatus WHEN 'F' THEN CAST(o_orderdate AS DATE)+30 END AS data_fim,
               CAST(CASE WHEN o_orderpriority='5-LOW' THEN 0 ELSE o_totalprice END AS DECIMAL(8,2)) AS valor_mensal
        FROM orders LEFT JOIN items l ON l.l_orderkey=o_orderkey""",
    "doacoes": """
        SELECT CAST(l_orderkey*8+l_linenumber AS BIGINT) AS id_doacao, CAST(o_custkey+1 AS BIGINT) AS id_viewer,
               CAST(l_suppkey+1 AS BIGINT) AS id_streamer, CAST(l_orderkey+1 AS BIGINT) AS id_transmissao,
               CAST(l_extendedprice AS DECIMAL(8,2)) AS valor, l_shipdate AS data_hora
        FROM lineitem JOIN orders ON o_orderkey=l_orderkey WHERE l_returnflag='R'""",
    "clips": f"""
        SELECT CAST(event_id+1 AS BIGINT) AS id_clip, {parent("orders")} AS id_transmissao,
               CAST(user_id+1 AS BIGINT) AS id_viewer, CAST(FLOOR(value) AS INT) AS visualizacoes, ts AS data_criacao
        FROM events WHERE event_type='view'""",
    "raids": f"""
        SELECT CAST(event_id+1 AS BIGINT) AS id_raid, {parent("supplier")} AS id_streamer_origem,
               {parent("supplier", "event_id+5")} AS id_streamer_destino,
               {parent("orders")} AS id_transmissao, CAST(FLOOR(value) AS INT) AS viewers_enviados,
               ts AS data_hora
        FROM events WHERE event_type='click'""",
    "moderadores": f"""
        SELECT CAST(event_id+1 AS BIGINT) AS id_moderador, CAST(user_id+1 AS BIGINT) AS id_viewer,
               {parent("supplier")} AS id_streamer, CAST(ts AS DATE) AS data_inicio,
               CASE WHEN event_id%4=0 THEN CAST(ts AS DATE)+CAST(event_id%7-1 AS INT) END AS data_fim
        FROM events WHERE event_type='purchase'""",
}

COLUMNS = {
    "plataformas": "id_plataforma, nome",
    "jogos": "id_jogo, nome, desenvolvedor, ano_lancamento, ativo",
    "streamers": "id_streamer, nome, pais, data_cadastro, id_plataforma",
    "viewers": "id_viewer, nome, pais, data_cadastro",
    "emotes": "id_emote, nome, id_streamer, disponivel_para",
    "transmissoes": "id_transmissao, id_streamer, id_jogo, data_inicio, data_fim, pico_viewers",
    "visualizacoes": "id_visualizacao, id_viewer, id_transmissao, minutos_assistidos, data_hora",
    "follows": "id_follow, id_viewer, id_streamer, data_follow, data_unfollow",
    "assinaturas": "id_assinatura, id_viewer, id_streamer, tipo, data_inicio, data_fim, valor_mensal",
    "doacoes": "id_doacao, id_viewer, id_streamer, id_transmissao, valor, data_hora",
    "clips": "id_clip, id_transmissao, id_viewer, visualizacoes, data_criacao",
    "raids": "id_raid, id_streamer_origem, id_streamer_destino, id_transmissao, viewers_enviados, data_hora",
    "moderadores": "id_moderador, id_viewer, id_streamer, data_inicio, data_fim",
}
TEXT = {"nome", "desenvolvedor", "pais", "disponivel_para", "tipo"}
CODES = {"disponivel_para", "tipo"}

# Reasons as SQL, in report order.
MISSING = "CASE WHEN {0} IS NULL THEN '{1}:{0}' END"
OUTSIDE = "CASE WHEN {0} NOT IN ({1}) THEN 'dominio_invalido:{0}' END"
REVERSED = "CASE WHEN {0} < {1} THEN 'temporal_invalido:{0}<{1}' END"


def missing(*names):
    return [MISSING.format(n, "nulo_obrigatorio") for n in names]


RULES = {
    "plataformas": missing("nome"),
    "jogos": missing("nome"),
    "streamers": missing("nome", "data_cadastro"),
    "viewers": missing("nome", "data_cadastro"),
    "emotes": missing("nome") + [OUTSIDE.format("disponivel_para", "'gratis', 'assinante'")],
    "transmissoes": missing("data_inicio", "data_fim") + [REVERSED.format("data_fim", "data_inicio")],
    "visualizacoes": missing("data_hora"),
    "follows": missing("data_follow") + [REVERSED.format("data_unfollow", "data_follow")],
    "assinaturas": missing("data_inicio")
    + [OUTSIDE.format("tipo", "'gratis', 'tier1', 'tier2', 'tier3'"), REVERSED.format("data_fim", "data_inicio")],
    "doacoes": missing("valor", "data_hora"),
    "clips": missing("data_criacao"),
    "raids": missing("data_hora"),
    "moderadores": missing("data_inicio") + [REVERSED.format("data_fim", "data_inicio")],
}


def key_of(table: str) -> str:
    return COLUMNS[table].split(",")[0]


def names_of(table: str) -> list[str]:
    return COLUMNS[table].split(", ")


def clean(name: str) -> str:
    if name in CODES:
        return f"LOWER(NULLIF(TRIM({name}), '')) AS {name}"
    return f"NULLIF(TRIM({name}), '') AS {name}" if name in TEXT else name


def reason(table: str) -> str:
    parts = [MISSING.format(key_of(table), "pk_nula"), *RULES[table]]
    return f"NULLIF(CONCAT_WS('; ', {', '.join(parts)}), '')"


def parts() -> dict[str, str]:
    found = {"items": ITEMS}
    for table, sql in SOURCES.items():
        order = ", ".join(f"{n} ASC NULLS FIRST" for n in names_of(table))
        found[f"src_{table}"] = sql
        found[f"typed_{table}"] = f"SELECT {', '.join(map(clean, names_of(table)))} FROM src_{table}"
        found[f"dq_{table}"] = f"SELECT *, {reason(table)} AS _motivo_rejeicao FROM typed_{table}"
        found[f"silver_{table}"] = (
            f"SELECT {COLUMNS[table]} FROM dq_{table} WHERE _motivo_rejeicao IS NULL "
            f"QUALIFY ROW_NUMBER() OVER (PARTITION BY {key_of(table)} ORDER BY {order}) = 1"
        )
    return {**found, **STAR, **MARTS}


UNKNOWN = "'(desconhecido)'"
STAR = {
    "dim_plataforma": f"""
        SELECT ROW_NUMBER() OVER (ORDER BY id_plataforma) AS sk_plataforma, id_plataforma, nome AS nome_plataforma
        FROM silver_plataformas UNION ALL SELECT -1, NULL, {UNKNOWN}""",
    "dim_streamer": f"""
        SELECT ROW_NUMBER() OVER (ORDER BY s.id_streamer) AS sk_streamer, s.id_streamer, s.nome AS nome_streamer,
               s.pais, s.data_cadastro, s.id_plataforma, p.nome AS nome_plataforma
        FROM silver_streamers s LEFT JOIN silver_plataformas p ON p.id_plataforma = s.id_plataforma
        UNION ALL SELECT -1, NULL, {UNKNOWN}, {UNKNOWN}, NULL, NULL, {UNKNOWN}""",
    "dim_viewer": f"""
        SELECT ROW_NUMBER() OVER (ORDER BY id_viewer) AS sk_viewer, id_viewer, nome AS nome_viewer, pais, data_cadastro
        FROM silver_viewers UNION ALL SELECT -1, NULL, {UNKNOWN}, {UNKNOWN}, NULL""",
    "dim_jogo": f"""
        SELECT ROW_NUMBER() OVER (ORDER BY id_jogo) AS sk_jogo, id_jogo, nome AS nome_jogo, desenvolvedor,
               ano_lancamento, ativo
        FROM silver_jogos UNION ALL SELECT -1, NULL, {UNKNOWN}, {UNKNOWN}, NULL, NULL""",
    "days": """
        SELECT CAST(data_inicio AS DATE) AS d FROM silver_transmissoes
        UNION ALL SELECT CAST(data_hora AS DATE) FROM silver_visualizacoes
        UNION ALL SELECT CAST(data_hora AS DATE) FROM silver_doacoes
        UNION ALL SELECT data_inicio FROM silver_assinaturas""",
    "calendar": """
        SELECT CAST(UNNEST(GENERATE_SERIES(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS data
        FROM (SELECT MIN(d) AS lo, MAX(d) AS hi FROM days)""",
    "dim_tempo": f"""
        SELECT CAST(STRFTIME(data, '%Y%m%d') AS INT) AS sk_tempo, data, CAST(YEAR(data) AS INT) AS ano,
               CAST(QUARTER(data) AS INT) AS trimestre, CAST(MONTH(data) AS INT) AS mes, MONTHNAME(data) AS nome_mes,
               CAST(DAY(data) AS INT) AS dia, CAST(DAYOFWEEK(data)+1 AS INT) AS dia_semana,
               DAYNAME(data) AS nome_dia_semana, DAYOFWEEK(data) IN (0, 6) AS fim_de_semana
        FROM calendar
        UNION ALL SELECT -1, NULL, NULL, NULL, NULL, {UNKNOWN}, NULL, NULL, {UNKNOWN}, NULL""",
    "fato_transmissoes": """
        SELECT COALESCE(CAST(STRFTIME(f.data_inicio, '%Y%m%d') AS INT), -1) AS sk_tempo,
               COALESCE(s.sk_streamer, -1) AS sk_streamer, COALESCE(j.sk_jogo, -1) AS sk_jogo, f.id_transmissao,
               f.pico_viewers, ROUND(DATE_DIFF('second', f.data_inicio, f.data_fim) / 60.0, 2) AS duracao_minutos
        FROM silver_transmissoes f
        LEFT JOIN dim_streamer s ON s.id_streamer = f.id_streamer LEFT JOIN dim_jogo j ON j.id_jogo = f.id_jogo""",
    "fato_visualizacoes": """
        SELECT COALESCE(CAST(STRFTIME(f.data_hora, '%Y%m%d') AS INT), -1) AS sk_tempo,
               COALESCE(v.sk_viewer, -1) AS sk_viewer, COALESCE(s.sk_streamer, -1) AS sk_streamer,
               COALESCE(j.sk_jogo, -1) AS sk_jogo, f.id_visualizacao, f.id_transmissao, f.minutos_assistidos
        FROM silver_visualizacoes f LEFT JOIN silver_transmissoes t ON t.id_transmissao = f.id_transmissao
        LEFT JOIN dim_viewer v ON v.id_viewer = f.id_viewer
        LEFT JOIN dim_streamer s ON s.id_streamer = t.id_streamer LEFT JOIN dim_jogo j ON j.id_jogo = t.id_jogo""",
    "fato_doacoes": """
        SELECT COALESCE(CAST(STRFTIME(f.data_hora, '%Y%m%d') AS INT), -1) AS sk_tempo,
               COALESCE(v.sk_viewer, -1) AS sk_viewer, COALESCE(s.sk_streamer, -1) AS sk_streamer,
               f.id_doacao, f.id_transmissao, f.valor
        FROM silver_doacoes f LEFT JOIN dim_viewer v ON v.id_viewer = f.id_viewer
        LEFT JOIN dim_streamer s ON s.id_streamer = f.id_streamer""",
    "fato_assinaturas": """
        SELECT COALESCE(CAST(STRFTIME(f.data_inicio, '%Y%m%d') AS INT), -1) AS sk_tempo,
               COALESCE(v.sk_viewer, -1) AS sk_viewer, COALESCE(s.sk_streamer, -1) AS sk_streamer,
               f.id_assinatura, f.tipo, f.valor_mensal, CAST(DATE_DIFF('day', f.data_inicio, f.data_fim) AS INT)
               AS duracao_dias, f.data_fim IS NULL AS ativa
        FROM silver_assinaturas f LEFT JOIN dim_viewer v ON v.id_viewer = f.id_viewer
        LEFT JOIN dim_streamer s ON s.id_streamer = f.id_streamer""",
}


def rounded(top: str, bottom: str, digits: int) -> str:
    """top / bottom rounded half away from zero, in whole numbers so that no tie is lost."""
    top = f"CAST({top} AS HUGEINT) * {10**digits}"
    whole = f"SIGN({top}) * ((2 * ABS({top}) + ({bottom})) // (2 * ({bottom})))"
    return f"CAST({whole} AS DOUBLE) / {10**digits}"


def cents(amount: str) -> str:
    return f"ROUND(({amount}) * 100)"


MEAN_PEAK = rounded("SUM(pico_viewers)", "COUNT(pico_viewers)", 1)
MEAN_LENGTH = rounded(cents("SUM(duracao_minutos)"), "COUNT(duracao_minutos) * 100", 1)
HOURS = rounded(cents("SUM(duracao_minutos)"), "6000", 1)
MARTS = {
    "agg_streamer_visao_geral": f"""
        SELECT d.sk_streamer, d.nome_streamer, d.pais, d.nome_plataforma,
               COALESCE(qtd_transmissoes, 0) AS qtd_transmissoes,
               CAST(COALESCE(pico_viewers_medio, 0) AS DOUBLE) AS pico_viewers_medio,
               CAST(COALESCE(horas_transmitidas, 0) AS DOUBLE) AS horas_transmitidas,
               CAST(COALESCE(minutos_assistidos, 0) AS BIGINT) AS minutos_assistidos,
               COALESCE(viewers_unicos, 0) AS viewers_unicos, COALESCE(total_doacoes, 0) AS total_doacoes,
               COALESCE(qtd_doacoes, 0) AS qtd_doacoes, COALESCE(assinaturas_ativas, 0) AS assinaturas_ativas,
               COALESCE(mrr, 0) AS mrr
        FROM dim_streamer d
        LEFT JOIN (SELECT sk_streamer, COUNT(*) AS qtd_transmissoes, {MEAN_PEAK} AS pico_viewers_medio,
                   {HOURS} AS horas_transmitidas FROM fato_transmissoes GROUP BY sk_streamer) USING (sk_streamer)
        LEFT JOIN (SELECT sk_streamer, SUM(minutos_assistidos) AS minutos_assistidos,
                   COUNT(DISTINCT sk_viewer) AS viewers_unicos FROM fato_visualizacoes GROUP BY sk_streamer)
                   USING (sk_streamer)
        LEFT JOIN (SELECT sk_streamer, SUM(valor) AS total_doacoes, COUNT(*) AS qtd_doacoes
                   FROM fato_doacoes GROUP BY sk_streamer) USING (sk_streamer)
        LEFT JOIN (SELECT sk_streamer, COUNT(*) AS assinaturas_ativas, SUM(valor_mensal) AS mrr
                   FROM fato_assinaturas WHERE ativa GROUP BY sk_streamer) USING (sk_streamer)
        WHERE d.sk_streamer <> -1""",
    "agg_receita_mensal": """
        SELECT ano, mes, MONTHNAME(MAKE_DATE(ano, mes, 1)) AS nome_mes,
               COALESCE(receita_doacoes, 0) AS receita_doacoes, COALESCE(qtd_doacoes, 0) AS qtd_doacoes,
               COALESCE(novas_assinaturas, 0) AS novas_assinaturas,
               COALESCE(receita_assinaturas, 0) AS receita_assinaturas,
               COALESCE(receita_doacoes, 0) + COALESCE(receita_assinaturas, 0) AS receita_total
        FROM (SELECT ano, mes, SUM(valor) AS receita_doacoes, COUNT(*) AS qtd_doacoes
              FROM fato_doacoes JOIN dim_tempo USING (sk_tempo) GROUP BY ano, mes)
        FULL JOIN (SELECT ano, mes, COUNT(*) AS novas_assinaturas, SUM(valor_mensal) AS receita_assinaturas
              FROM fato_assinaturas JOIN dim_tempo USING (sk_tempo) GROUP BY ano, mes) USING (ano, mes)""",
    "agg_jogo_popularidade": f"""
        SELECT d.sk_jogo, d.nome_jogo, d.desenvolvedor, d.ano_lancamento,
               COALESCE(qtd_transmissoes, 0) AS qtd_transmissoes,
               COALESCE(streamers_distintos, 0) AS streamers_distintos,
               CAST(COALESCE(pico_viewers_medio, 0) AS DOUBLE) AS pico_viewers_medio,
               CAST(COALESCE(duracao_media_min, 0) AS DOUBLE) AS duracao_media_min,
               CAST(COALESCE(minutos_assistidos, 0) AS BIGINT) AS minutos_assistidos
        FROM dim_jogo d
        LEFT JOIN (SELECT sk_jogo, COUNT(*) AS qtd_transmissoes, COUNT(DISTINCT sk_streamer) AS streamers_distintos,
                   {MEAN_PEAK} AS pico_viewers_medio,
                   {MEAN_LENGTH} AS duracao_media_min
                   FROM fato_transmissoes GROUP BY sk_jogo) USING (sk_jogo)
        LEFT JOIN (SELECT sk_jogo, SUM(minutos_assistidos) AS minutos_assistidos
                   FROM fato_visualizacoes GROUP BY sk_jogo) USING (sk_jogo)
        WHERE d.sk_jogo <> -1""",
    "streamer_platform": """
        SELECT s.sk_streamer, p.sk_plataforma FROM dim_streamer s
        JOIN dim_plataforma p ON p.id_plataforma = s.id_plataforma
        WHERE s.sk_streamer <> -1 AND p.sk_plataforma <> -1""",
    "agg_plataforma_resumo": """
        SELECT d.sk_plataforma, d.nome_plataforma, COALESCE(qtd_streamers, 0) AS qtd_streamers,
               COALESCE(total_doacoes, 0) AS total_doacoes,
               CAST(COALESCE(minutos_assistidos, 0) AS BIGINT) AS minutos_assistidos
        FROM dim_plataforma d
        LEFT JOIN (SELECT sk_plataforma, COUNT(*) AS qtd_streamers FROM streamer_platform GROUP BY sk_plataforma)
                  USING (sk_plataforma)
        LEFT JOIN (SELECT sk_plataforma, SUM(valor) AS total_doacoes FROM fato_doacoes
                   JOIN streamer_platform USING (sk_streamer) GROUP BY sk_plataforma) USING (sk_plataforma)
        LEFT JOIN (SELECT sk_plataforma, SUM(minutos_assistidos) AS minutos_assistidos FROM fato_visualizacoes
                   JOIN streamer_platform USING (sk_streamer) GROUP BY sk_plataforma) USING (sk_plataforma)
        WHERE d.sk_plataforma <> -1""",
}

MONEY = "CAST({0} AS DOUBLE) AS {0}"
MART_COLUMNS = {
    "streamer_visao_geral": "* REPLACE (CAST(total_doacoes AS DOUBLE) AS total_doacoes, CAST(mrr AS DOUBLE) AS mrr)",
    "receita_mensal": "* REPLACE (CAST(receita_doacoes AS DOUBLE) AS receita_doacoes, CAST(receita_assinaturas AS "
    "DOUBLE) AS receita_assinaturas, CAST(receita_total AS DOUBLE) AS receita_total)",
    "jogo_popularidade": "*",
    "plataforma_resumo": "* REPLACE (CAST(total_doacoes AS DOUBLE) AS total_doacoes)",
}

CALENDAR = """CAST(STRFTIME(d, '%Y%m%d') AS INT) AS sk_tempo, d AS data, CAST(YEAR(d) AS INT) AS ano,
    CAST(QUARTER(d) AS INT) AS trimestre, CAST(MONTH(d) AS INT) AS mes, MONTHNAME(d) AS nome_mes,
    CAST(DAY(d) AS INT) AS dia, CAST(DAYOFWEEK(d)+1 AS INT) AS dia_semana, DAYNAME(d) AS nome_dia_semana,
    DAYOFWEEK(d) IN (0, 6) AS fim_de_semana"""

MOM = f"""
    SELECT ano, mes, CAST(receita_total AS DOUBLE) AS receita_total, CAST(antes AS DOUBLE) AS receita_mes_anterior,
           CASE WHEN antes IS NULL OR antes = 0 THEN NULL ELSE
                {rounded("(receita_total - antes) * 10000", "CAST(antes * 100 AS HUGEINT)", 2)} END AS variacao_pct
    FROM (SELECT ano, mes, receita_total, LAG(receita_total) OVER (ORDER BY ano, mes) AS antes
          FROM agg_receita_mensal)"""


def orphans(fact: str, sk: str) -> str:
    return f"SELECT '{fact}' AS fato, '{sk}' AS dim, COUNT(*) AS orfas FROM {fact} WHERE {sk} = -1"


def unknown_rows(fact: str, keys: str) -> str:
    broken = " OR ".join(f"{sk} = -1" for sk in keys.split())
    return (
        f"SELECT '{fact}' AS fato, COUNT(*) AS linhas, COUNT(*) FILTER (WHERE {broken}) AS fk_desconhecidas FROM {fact}"
    )


FINAL = {
    "bronze_audit": " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, '2024-01-01' AS _extraction_date, COUNT(*) AS linhas, COUNT(*) AS carimbadas "
        f"FROM src_{t}"
        for t in SOURCES
    ),
    "csv_infer_scan": "SELECT * FROM src_jogos",
    "landing_table_name": " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, COUNT(*) AS linhas FROM src_{t}" for t in SOURCES
    ),
    "landing_line_breaks": """
        SELECT id_jogo, nome || CASE id_jogo%4 WHEN 0 THEN CHR(10) WHEN 1 THEN CHR(13) || CHR(10) WHEN 2 THEN '","'
               ELSE '\\n\\' END || 'fim' AS nome FROM src_jogos""",
    "landing_roundtrip": "SELECT * FROM src_transmissoes",
    "rowcount_report": " UNION ALL ".join(f"SELECT '{t}' AS tabela, COUNT(*) AS linhas FROM src_{t}" for t in SOURCES)
    + " UNION ALL SELECT 'TOTAL', CAST(" + " + ".join(f"(SELECT COUNT(*) FROM src_{t})" for t in SOURCES) + " AS BIGINT)",
    "audit_prune": "SELECT * FROM typed_streamers",
    "std_strings": """
        SELECT id_emote, CASE WHEN id_emote%7<>0 THEN nome END AS nome, id_streamer,
               LOWER(TRIM(disponivel_para)) AS disponivel_para FROM src_emotes""",
    "std_boolean": """
        SELECT id_jogo, CASE WHEN id_jogo%12 < 5 THEN TRUE WHEN id_jogo%12 < 10 THEN FALSE END AS ativo FROM src_jogos""",
    "std_numeric_dates": """
        SELECT o_orderkey, CASE WHEN o_orderkey%4 IN (0, 3) THEN CAST(TRUNC(o_totalprice) AS INT) END AS inteiro,
               CAST(CAST(o_totalprice AS DECIMAL(8,2)) AS DOUBLE) AS valor,
               CASE WHEN o_totalprice < 10000 THEN CAST(CAST(o_totalprice AS DECIMAL(8,2)) AS DOUBLE) END AS valor_curto,
               CASE WHEN o_orderkey%4 <> 2 THEN CAST(o_orderdate AS DATE) END AS dia
        FROM orders""",
    "dq_valid": "SELECT * EXCLUDE (_motivo_rejeicao) FROM dq_transmissoes WHERE _motivo_rejeicao IS NULL",
    "dq_quarantine": "SELECT * REPLACE (CAST(valor_mensal AS DOUBLE) AS valor_mensal) FROM dq_assinaturas "
    "WHERE _motivo_rejeicao IS NOT NULL",
    "dq_strict_casts": f"""
        SELECT NULLIF(CONCAT_WS('; ', motivo, CASE WHEN id_assinatura%11=0 THEN 'cast_invalido:data_fim' END,
               CASE WHEN id_assinatura%7=0 THEN 'cast_invalido:valor_mensal' END), '') AS motivo, COUNT(*) AS linhas
        FROM (SELECT id_assinatura, {reason('assinaturas')} AS motivo FROM (
            SELECT * REPLACE (CASE WHEN id_assinatura%11<>0 THEN data_fim END AS data_fim) FROM typed_assinaturas))
        GROUP BY 1""",
    "dedup_visualizacoes": "SELECT * FROM silver_visualizacoes",
    "dedup_counts": "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, COUNT(*) - COUNT(DISTINCT {key_of(t)}) AS duplicados FROM dq_{t} "
        f"WHERE _motivo_rejeicao IS NULL"
        for t in SOURCES
    )
    + ") WHERE duplicados > 0",
    "dq_report": " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, COUNT(*) AS lidos, (SELECT COUNT(*) FROM silver_{t}) AS validos, "
        f"COUNT(_motivo_rejeicao) AS quarentena, "
        f"COUNT(*) - COUNT(_motivo_rejeicao) - (SELECT COUNT(*) FROM silver_{t}) AS duplicados FROM dq_{t}"
        for t in SOURCES
    ),
    "lookup_unmatched": """
        SELECT COALESCE(s.sk_streamer, -1) AS sk_streamer, COUNT(*) AS linhas FROM silver_follows f
        LEFT JOIN dim_streamer s ON s.id_streamer = f.id_streamer GROUP BY 1""",
    "lookup_hot_keys": """
        SELECT COALESCE(v.sk_viewer, -1) AS sk_viewer, COUNT(*) AS linhas,
               CAST(SUM(minutos_assistidos) AS BIGINT) AS minutos
        FROM silver_visualizacoes f LEFT JOIN dim_viewer v ON v.id_viewer = f.id_viewer GROUP BY 1""",
    "lookup_hot_streamer": """
        SELECT COALESCE(s.sk_streamer, -1) AS sk_streamer, COUNT(*) AS linhas, MAX(id_follow) AS ultimo
        FROM silver_follows f LEFT JOIN dim_streamer s ON s.id_streamer = f.id_streamer GROUP BY 1""",
    "smart_date_key": """
        SELECT id_transmissao, COALESCE(CAST(STRFTIME(data_fim, '%Y%m%d') AS INT), -1) AS sk_tempo
        FROM src_transmissoes""",
    "fact_unknown_fk_counts": " UNION ALL ".join(
        [
            unknown_rows("fato_transmissoes", "sk_tempo sk_streamer sk_jogo"),
            unknown_rows("fato_visualizacoes", "sk_tempo sk_viewer sk_streamer sk_jogo"),
            unknown_rows("fato_doacoes", "sk_tempo sk_viewer sk_streamer"),
            unknown_rows("fato_assinaturas", "sk_tempo sk_viewer sk_streamer"),
        ]
    ),
    "fn_calendar": f"SELECT o_orderkey, {CALENDAR} FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)",
    "fn_reason_concat": f"""
        SELECT motivo, COUNT(*) AS linhas FROM (
            SELECT {reason('assinaturas')} AS motivo FROM (
                SELECT CASE WHEN id_assinatura%11<>0 THEN id_assinatura END AS id_assinatura, tipo,
                       CASE WHEN id_assinatura%5<>0 THEN data_inicio END AS data_inicio,
                       CASE WHEN id_assinatura%3=0 THEN data_inicio - 1 ELSE data_fim END AS data_fim
                FROM typed_assinaturas)) GROUP BY motivo""",
    "fn_null_guards": """
        SELECT o_orderkey, CASE WHEN o_orderkey%3<>0 AND o_orderkey%2=1 THEN o_totalprice END AS razao,
               CASE WHEN o_orderkey%3<>0 AND o_orderkey%2=1 THEN
                    CAST(ROUND(CAST((o_totalprice-1)*100 AS DECIMAL(20,6)), 0) AS DOUBLE)/100 END AS variacao
        FROM orders""",
    "star_sql": """
        SELECT nome_plataforma, CAST(SUM(valor) AS DOUBLE) AS total_doacoes, COUNT(*) AS qtd_doacoes
        FROM fato_doacoes JOIN dim_streamer USING (sk_streamer) GROUP BY nome_plataforma""",
    "layers_end_to_end": f"SELECT {MART_COLUMNS['receita_mensal']} FROM agg_receita_mensal",
    "layers_all_outputs": " UNION ALL ".join(
        f"SELECT '{name}' AS tabela, COUNT(*) AS linhas, CAST(SUM({key}) AS BIGINT) AS chaves FROM {table}"
        for name, table, key in [
            *[(t, f"silver_{t}", key_of(t)) for t in SOURCES],
            *[(f"dim_{d}", f"dim_{d}", f"sk_{d}") for d in ("plataforma", "streamer", "viewer", "jogo", "tempo")],
            ("fato_transmissoes", "fato_transmissoes", "sk_streamer"),
            *[(f"fato_{f}", f"fato_{f}", "sk_viewer") for f in ("visualizacoes", "doacoes", "assinaturas")],
            ("agg_streamer_visao_geral", "agg_streamer_visao_geral", "sk_streamer"),
            ("agg_receita_mensal", "agg_receita_mensal", "mes"),
            ("agg_jogo_popularidade", "agg_jogo_popularidade", "sk_jogo"),
            ("agg_plataforma_resumo", "agg_plataforma_resumo", "sk_plataforma"),
        ]
    ),
    "q1_top_streamers_donations": """
        SELECT nome_streamer, nome_plataforma, CAST(SUM(valor) AS DOUBLE) AS total_doacoes, COUNT(*) AS qtd_doacoes
        FROM fato_doacoes JOIN dim_streamer USING (sk_streamer) GROUP BY nome_streamer, nome_plataforma
        ORDER BY SUM(valor) DESC, nome_streamer, nome_plataforma LIMIT 10""",
    "q2_monthly_donations": """
        SELECT ano, mes, nome_mes, CAST(SUM(valor) AS DOUBLE) AS receita_doacoes
        FROM fato_doacoes JOIN dim_tempo USING (sk_tempo) GROUP BY ano, mes, nome_mes""",
    "q3_top_games": f"""
        SELECT nome_jogo, COUNT(*) AS qtd_transmissoes, {MEAN_PEAK} AS pico_medio,
               {MEAN_LENGTH} AS duracao_media_min
        FROM fato_transmissoes JOIN dim_jogo USING (sk_jogo) GROUP BY nome_jogo
        ORDER BY COUNT(*) DESC, nome_jogo LIMIT 15""",
    "q4_watch_by_country": """
        SELECT pais, CAST(SUM(minutos_assistidos) AS BIGINT) AS minutos_totais,
               COUNT(DISTINCT sk_viewer) AS viewers_distintos
        FROM fato_visualizacoes JOIN dim_viewer USING (sk_viewer) GROUP BY pais""",
    "q5_active_mrr": """
        SELECT tipo, COUNT(*) AS assinaturas_ativas, CAST(SUM(valor_mensal) AS DOUBLE) AS mrr
        FROM fato_assinaturas WHERE ativa GROUP BY tipo""",
    "q6_engagement_fanout": """
        SELECT nome_streamer, CAST(SUM(minutos_assistidos) AS DOUBLE) AS minutos_assistidos,
               CAST(COALESCE(SUM(valor), 0) AS DOUBLE) AS total_doacoes
        FROM dim_streamer s LEFT JOIN fato_visualizacoes v ON v.sk_streamer = s.sk_streamer
        LEFT JOIN fato_doacoes d ON d.sk_streamer = s.sk_streamer
        WHERE s.sk_streamer <> -1 GROUP BY nome_streamer
        ORDER BY COALESCE(SUM(valor), 0) DESC, nome_streamer LIMIT 20""",
    "q6_engagement_drill_across": """
        SELECT nome_streamer, CAST(SUM(minutos) AS BIGINT) AS minutos_assistidos,
               CAST(COALESCE(SUM(valor), 0) AS DOUBLE) AS total_doacoes
        FROM dim_streamer s
        LEFT JOIN (SELECT sk_streamer, SUM(minutos_assistidos) AS minutos FROM fato_visualizacoes GROUP BY 1)
                  USING (sk_streamer)
        LEFT JOIN (SELECT sk_streamer, SUM(valor) AS valor FROM fato_doacoes GROUP BY 1) USING (sk_streamer)
        WHERE s.sk_streamer <> -1 GROUP BY nome_streamer
        ORDER BY COALESCE(SUM(valor), 0) DESC, nome_streamer LIMIT 20""",
    "q7_referential_audit": " UNION ALL ".join(
        [
            orphans("fato_doacoes", "sk_viewer"),
            orphans("fato_doacoes", "sk_streamer"),
            orphans("fato_transmissoes", "sk_streamer"),
            orphans("fato_transmissoes", "sk_jogo"),
            orphans("fato_visualizacoes", "sk_viewer"),
            orphans("fato_assinaturas", "sk_streamer"),
        ]
    ),
    "kpi1_total_revenue": "SELECT CAST(SUM(receita_total) AS DOUBLE) AS receita_total_global FROM agg_receita_mensal",
    "kpi1_mom_change": f"{MOM} ORDER BY ano DESC, mes DESC LIMIT 1",
    "kpi1_mom_series": MOM,
    "kpi2_avg_donation": f"""
        SELECT {rounded("SUM(receita_doacoes) * 100", "NULLIF(SUM(qtd_doacoes), 0) * 100", 2)}
               AS valor_medio_por_doacao FROM agg_receita_mensal WHERE qtd_doacoes > 0""",
    "kpi3_total_broadcasts": """
        SELECT CAST(SUM(qtd_transmissoes) AS BIGINT) AS total_transmissoes FROM agg_streamer_visao_geral""",
    "kpi3_top_streamers": """
        SELECT nome_streamer, nome_plataforma, qtd_transmissoes, horas_transmitidas FROM agg_streamer_visao_geral
        WHERE qtd_transmissoes > 0 ORDER BY qtd_transmissoes DESC, nome_streamer, sk_streamer LIMIT 10""",
    "kpi3_broadcasts_by_month": """
        SELECT ano, mes, COUNT(*) AS qtd_transmissoes FROM fato_transmissoes JOIN dim_tempo USING (sk_tempo)
        GROUP BY ano, mes""",
    "kpi4_active_viewers": """
        SELECT CAST(SUM(viewers_unicos) AS BIGINT) AS viewers_ativos_total FROM agg_streamer_visao_geral
        WHERE viewers_unicos > 0""",
    "kpi4_distinct_viewers": "SELECT COUNT(DISTINCT sk_viewer) AS viewers_distintos_total FROM fato_visualizacoes "
    "WHERE sk_viewer <> -1",
    "kpi4_viewers_by_platform": """
        SELECT nome_plataforma, CAST(SUM(viewers_unicos) AS BIGINT) AS viewers_ativos,
               CAST(SUM(minutos_assistidos) AS BIGINT) AS minutos_assistidos_total
        FROM agg_streamer_visao_geral GROUP BY nome_plataforma""",
    "metric1_revenue_by_platform": """
        SELECT nome_plataforma, CAST(SUM(total_doacoes) AS DOUBLE) AS total_doacoes FROM agg_plataforma_resumo
        GROUP BY nome_plataforma""",
    "metric2_top_games": """
        SELECT nome_jogo, qtd_transmissoes FROM agg_jogo_popularidade WHERE qtd_transmissoes > 0
        ORDER BY qtd_transmissoes DESC, nome_jogo, sk_jogo LIMIT 10""",
    "doc_revenue_per_streamer": """
        SELECT sk_streamer, nome_streamer, ano, mes, CAST(COALESCE(SUM(v), 0) AS DOUBLE) AS receita_total
        FROM (SELECT sk_streamer, sk_tempo, valor AS v FROM fato_doacoes
              UNION ALL SELECT sk_streamer, sk_tempo, valor_mensal FROM fato_assinaturas)
        JOIN dim_tempo USING (sk_tempo) JOIN dim_streamer USING (sk_streamer)
        WHERE sk_streamer <> -1 GROUP BY sk_streamer, nome_streamer, ano, mes""",
    "doc_watch_hours": """
        SELECT sk_jogo, nome_jogo, ano, mes, CAST(SUM(minutos_assistidos) AS DOUBLE) / 60 AS horas_assistidas
        FROM fato_visualizacoes JOIN dim_tempo USING (sk_tempo) JOIN dim_jogo USING (sk_jogo)
        WHERE sk_jogo <> -1 GROUP BY sk_jogo, nome_jogo, ano, mes""",
    "doc_avg_peak_per_game": """
        SELECT sk_jogo, nome_jogo, AVG(pico_viewers) AS pico_medio
        FROM fato_transmissoes JOIN dim_jogo USING (sk_jogo) WHERE sk_jogo <> -1 GROUP BY sk_jogo, nome_jogo""",
    "doc_unique_viewers": """
        SELECT sk_streamer, nome_streamer, ano, mes, COUNT(DISTINCT sk_viewer) AS viewers_unicos
        FROM fato_visualizacoes JOIN dim_tempo USING (sk_tempo) JOIN dim_streamer USING (sk_streamer)
        WHERE sk_streamer <> -1 GROUP BY sk_streamer, nome_streamer, ano, mes""",
    "doc_avg_ticket": "SELECT CAST(SUM(valor) AS DOUBLE) / COUNT(valor) AS ticket_medio FROM fato_doacoes",
    "doc_avg_duration": """
        SELECT ano, mes, CAST(SUM(CAST(duracao_minutos AS DECIMAL(18,2))) AS DOUBLE) / COUNT(duracao_minutos) AS duracao_media_min
        FROM fato_transmissoes JOIN dim_tempo USING (sk_tempo) GROUP BY ano, mes""",
    "doc_platform_revenue_mrr": """
        SELECT nome_plataforma, CAST(COALESCE(d, 0) + COALESCE(m, 0) AS DOUBLE) AS receita_total
        FROM dim_plataforma
        LEFT JOIN (SELECT sk_plataforma, SUM(valor) AS d FROM fato_doacoes JOIN streamer_platform USING (sk_streamer)
                   GROUP BY 1) USING (sk_plataforma)
        LEFT JOIN (SELECT sk_plataforma, SUM(valor_mensal) AS m FROM fato_assinaturas
                   JOIN streamer_platform USING (sk_streamer) WHERE ativa GROUP BY 1) USING (sk_plataforma)
        WHERE sk_plataforma <> -1""",
}

# What a run makes again after donations have landed anew.
REMADE = {
    "bronze doacoes",
    "silver doacoes",
    "star dim_tempo",
    "star fato_doacoes",
    "marts agg_streamer_visao_geral",
    "marts agg_receita_mensal",
    "marts agg_plataforma_resumo",
}


def run_log() -> str:
    dims = [f"dim_{d}" for d in ("plataforma", "streamer", "viewer", "jogo", "tempo")]
    facts = [f"fato_{f}" for f in ("transmissoes", "visualizacoes", "doacoes", "assinaturas")]
    made = [("bronze", t, f"src_{t}") for t in SOURCES] + [("silver", t, f"silver_{t}") for t in SOURCES]
    made += [("star", t, t) for t in dims + facts] + [("marts", t, t) for t in MARTS if t.startswith("agg_")]
    return " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, '{name}' AS \"table\", "
        f"'{'overwrite' if f'{stage} {name}' in REMADE else 'unchanged'}' AS operation, COUNT(*) AS rows FROM {source}"
        for stage, name, source in made
    )


def types_of(name: str, table: str) -> str:
    """Columns with their types, in the words of the other engine, and how many values they have."""
    kind = (
        "CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
        "ELSE LOWER(column_type) END"
    )
    return f"""
        SELECT '{name}' AS tabela, coluna, {kind} AS tipo, preenchidas
        FROM (UNPIVOT (SELECT COUNT(COLUMNS(*)) AS "\\0" FROM {table}) ON COLUMNS(*) INTO NAME coluna VALUE preenchidas)
        JOIN (DESCRIBE SELECT * FROM {table}) ON column_name = coluna"""


WATCHED = "FROM fato_visualizacoes JOIN dim_tempo USING (sk_tempo) WHERE sk_viewer <> -1"
FINAL |= {
    "quarantine_all": " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, CAST({key_of(t)} AS BIGINT) AS chave, _motivo_rejeicao AS motivo FROM dq_{t} "
        "WHERE _motivo_rejeicao IS NOT NULL"
        for t in SOURCES
    ),
    "layer_types": " UNION ALL ".join(
        [types_of(t, f"silver_{t}") for t in SOURCES]
        + [types_of(f"dim_{d}", f"dim_{d}") for d in ("plataforma", "streamer", "viewer", "jogo", "tempo")]
        + [types_of(f"fato_{f}", f"fato_{f}") for f in ("transmissoes", "visualizacoes", "doacoes", "assinaturas")]
    ),
    "landing_foreign": """
        SELECT id_jogo, nome || CASE id_jogo%4 WHEN 0 THEN CHR(10) WHEN 1 THEN 'C:\\new\\run' WHEN 2 THEN '","'
               ELSE '\\n\\' END || 'fim' AS nome FROM src_jogos""",
    "run_resumed": run_log(),
    "dedup_isolated": "SELECT * FROM silver_visualizacoes",
    "doc_unique_viewers_rollup": f"""
        SELECT 'streamer_mes' AS nivel, sk_streamer, ano, mes, COUNT(DISTINCT sk_viewer) AS viewers_unicos
        {WATCHED} AND sk_streamer <> -1 GROUP BY sk_streamer, ano, mes
        UNION ALL SELECT 'streamer', sk_streamer, NULL, NULL, COUNT(DISTINCT sk_viewer)
        {WATCHED} AND sk_streamer <> -1 GROUP BY sk_streamer
        UNION ALL SELECT 'mes', NULL, ano, mes, COUNT(DISTINCT sk_viewer) {WATCHED} GROUP BY ano, mes
        UNION ALL SELECT 'total', NULL, NULL, NULL, COUNT(DISTINCT sk_viewer) {WATCHED}""",
    "kpi4_true_viewers_by_platform": """
        SELECT nome_plataforma, COUNT(DISTINCT sk_viewer) AS viewers_unicos
        FROM fato_visualizacoes JOIN dim_streamer USING (sk_streamer)
        WHERE sk_viewer <> -1 AND sk_streamer <> -1 GROUP BY nome_plataforma""",
    "fato_doacoes_month": "SELECT * REPLACE (CAST(valor AS DOUBLE) AS valor) FROM fato_doacoes WHERE sk_tempo // 100 = 199603",
    "doc_revenue_quarter": """
        SELECT sk_streamer, nome_streamer, ano, mes, CAST(COALESCE(SUM(v), 0) AS DOUBLE) AS receita_total
        FROM (SELECT sk_streamer, sk_tempo, valor AS v FROM fato_doacoes
              UNION ALL SELECT sk_streamer, sk_tempo, valor_mensal FROM fato_assinaturas)
        JOIN dim_tempo USING (sk_tempo) JOIN dim_streamer USING (sk_streamer)
        WHERE sk_streamer <> -1 AND ano = 1996 AND mes <= 3 GROUP BY sk_streamer, nome_streamer, ano, mes""",
    "fato_visualizacoes_bucketed": "SELECT * FROM fato_visualizacoes",
    "clustered_scan": """
        SELECT 'streamer' AS recorte, COUNT(*) AS linhas, CAST(COALESCE(SUM(minutos_assistidos), 0) AS BIGINT) AS minutos
        FROM fato_visualizacoes WHERE sk_streamer = 3
        UNION ALL SELECT 'semana', COUNT(*), CAST(COALESCE(SUM(minutos_assistidos), 0) AS BIGINT)
        FROM fato_visualizacoes WHERE sk_tempo BETWEEN 19960311 AND 19960317""",
    "rowcount_footer": " UNION ALL ".join(f"SELECT '{t}' AS tabela, COUNT(*) AS linhas FROM silver_{t}" for t in SOURCES)
    + " UNION ALL SELECT 'TOTAL', CAST(" + " + ".join(f"(SELECT COUNT(*) FROM silver_{t})" for t in SOURCES) + " AS BIGINT)",
    "fact_date_bounds": " UNION ALL ".join(
        f"SELECT 'fato_{f}' AS fato, COUNT(*) AS linhas, MIN(sk_tempo) AS min_sk_tempo, MAX(sk_tempo) AS max_sk_tempo "
        f"FROM fato_{f}"
        for f in ("transmissoes", "visualizacoes", "doacoes", "assinaturas")
    ),
    "sk_by_name": """
        SELECT id_jogo, nome, ROW_NUMBER() OVER (ORDER BY nome, id_jogo) AS sk
        FROM (SELECT id_jogo, 'jogo da plataforma: ' || STRING_SPLIT(nome, ' ')[1] AS nome FROM src_jogos)""",
    "lookup_by_name": """
        SELECT COALESCE(sk_pais, -1) AS sk_pais, COUNT(*) AS linhas FROM silver_viewers v
        LEFT JOIN (SELECT pais, ROW_NUMBER() OVER (ORDER BY pais) AS sk_pais
                   FROM (SELECT DISTINCT pais FROM silver_streamers WHERE pais IS NOT NULL)) c ON c.pais = v.pais
        GROUP BY 1""",
    "lookup_by_pair": """
        SELECT COALESCE(primeira, -1) AS primeira, COUNT(*) AS linhas
        FROM (SELECT CASE WHEN id_doacao%3=0 THEN hv ELSE id_viewer END AS quem,
                     CASE WHEN id_doacao%5<>0 THEN CASE WHEN id_doacao%3=0 THEN hs ELSE id_streamer END END AS canal
              FROM silver_doacoes, (SELECT id_viewer AS hv, id_streamer AS hs FROM silver_assinaturas
                                    WHERE id_streamer IS NOT NULL ORDER BY id_viewer, id_streamer LIMIT 1))
        LEFT JOIN (SELECT id_viewer, id_streamer, MIN(id_assinatura) AS primeira FROM silver_assinaturas
                   GROUP BY id_viewer, id_streamer) ON id_viewer = quem AND id_streamer = canal
        GROUP BY 1""",
}

DOUBLES = {"valor", "valor_mensal"}
MEASURES = ("valor", "valor_mensal", "duracao_minutos")


def money_list(table: str) -> str:
    return ", ".join(MONEY.format(n) if n in DOUBLES else n for n in names_of(table))


def bronze_list(table: str) -> str:
    def text(name):
        if name == "ativo":
            return "CASE WHEN ativo THEN 'True' WHEN NOT ativo THEN 'False' END AS ativo"
        return f"CAST({name} AS VARCHAR) AS {name}"

    return ", ".join(map(text, names_of(table)))


# Dates are shown as ISO text.
DATES = {
    "streamers": ["data_cadastro"],
    "viewers": ["data_cadastro"],
    "follows": ["data_follow", "data_unfollow"],
    "assinaturas": ["data_inicio", "data_fim"],
    "moderadores": ["data_inicio", "data_fim"],
}
DATED = {
    **{f"{kind}_{table}": names for table, names in DATES.items() for kind in ("std", "silver")},
    "audit_prune": DATES["streamers"],
    "dq_quarantine": DATES["assinaturas"],
    "dim_streamer": DATES["streamers"],
    "dim_viewer": DATES["viewers"],
    "dim_tempo": ["data"],
    "fn_calendar": ["data"],
    "std_numeric_dates": ["dia"],
}


def shown(name: str, final: str) -> str:
    casts = ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in DATED.get(name, ()))
    return f"SELECT * REPLACE ({casts}) FROM ({final.strip()})" if casts else final


def finals() -> dict[str, str]:
    found = {}
    for table in SOURCES:
        found[f"bronze_{table}"] = f"SELECT {bronze_list(table)}, '2024-01-01' AS _extraction_date FROM src_{table}"
        found[f"std_{table}"] = f"SELECT {money_list(table)} FROM typed_{table}"
        found[f"dq_reasons_{table}"] = f"SELECT {key_of(table)}, _motivo_rejeicao AS motivo FROM dq_{table}"
        found[f"silver_{table}"] = f"SELECT {money_list(table)} FROM silver_{table}"
    for name in STAR:
        if name.startswith(("dim_", "fato_")):
            casts = ", ".join(MONEY.format(n) for n in MEASURES if re.search(rf"\b{n}\b", STAR[name]))
            found[name] = f"SELECT * REPLACE ({casts}) FROM {name}" if casts else f"SELECT * FROM {name}"
    for name, columns in MART_COLUMNS.items():
        found[f"mart_{name}"] = f"SELECT {columns} FROM agg_{name}"
    return {name: shown(name, final) for name, final in {**found, **FINAL}.items()}


def statement(final: str, known: dict[str, str]) -> str:
    """``final`` with the WITH parts it refers to, in order of definition."""
    needed, pending = set(), [final]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in known:
            if name in words and name not in needed:
                needed.add(name)
                pending.append(known[name])
    listed = ",\n".join(f"{name} AS ({known[name].strip()})" for name in known if name in needed)
    return f"WITH {listed}\n{final.strip()}" if listed else final.strip()


def statements() -> dict[str, str]:
    known = parts()
    return {name: statement(final, known) for name, final in finals().items()}
