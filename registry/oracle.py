"""DuckDB SQL for every registered query that SQL can express.

Statements are put together from named CTEs; ``sql`` adds those a statement uses.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}
ORACLE: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def sql(final: str) -> str:
    """The statement preceded by the CTEs it needs, in definition order."""
    needed: set[str] = set()
    todo = [final]
    while todo:
        text = todo.pop()
        for name, body in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(body)
    ordered = [f"{n} AS ({b})" for n, b in CTES.items() if n in needed]
    return ("WITH " + ",\n".join(ordered) + "\n" if ordered else "") + final.strip()


def oracle(key: str, final: str) -> None:
    ORACLE[key] = sql(final)


# ---- the derived panel ----------------------------------------------------------------

cte("s_states", """
  SELECT lower(n_name) AS state_slug, 'n' || n_nationkey AS state_code,
         upper(n_name[1]) || lower(replace(n_name, '_', ' ')[2:]) AS state_name, lower(r_name) AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey""")
cte("s_months", """
  SELECT * FROM (VALUES ('janeiro', 1), ('fevereiro', 2), ('marco', 3), ('abril', 4), ('maio', 5), ('junho', 6),
    ('julho', 7), ('agosto', 8), ('setembro', 9), ('outubro', 10), ('novembro', 11), ('dezembro', 12))
    AS m(month_name, month_number)""")
cte("s_cells", """
  SELECT l_partkey // 10 AS item, n_nationkey, lower(n_name) AS state_slug, lower(r_name) AS region,
         year(published) AS y, quarter(published) AS q,
         (l_partkey // 10) % 3 <> 0 AND l_returnflag = 'R' AS desonerado,
         (l_suppkey + 4 * year(published) + quarter(published)) % 8 = 0 AS revisado,
         min(l_extendedprice) AS p, min(l_quantity) AS n, min(l_discount) AS d, max(l_tax) AS t
  FROM (SELECT *, CASE WHEN (n_nationkey + 4 * year(l_shipdate) + quarter(l_shipdate)) % 29 = 0
                  THEN l_shipdate + INTERVAL 3 MONTH ELSE l_shipdate END AS published
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
       JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL""")
cte("s_rows", """
  SELECT c.*, sz + y % 3 AS label,
         CASE item % 3 WHEN 0 THEN 'materiais' WHEN 1 THEN 'equipamentos' ELSE 'mao_de_obra' END AS report_type,
         CASE item % 3 WHEN 0 THEN 'Materiais' WHEN 1 THEN 'Equipamentos' ELSE 'Mão de Obra' END AS report_name,
         CASE q WHEN 1 THEN 'janeiro' WHEN 2 THEN 'abril' WHEN 3 THEN 'julho' ELSE 'outubro' END AS month
  FROM s_cells c JOIN (SELECT p_partkey // 10 AS item, max(p_size) AS sz FROM part GROUP BY 1) USING (item)""")
cte("s_panel", """
  SELECT CASE WHEN (item + q) % 2 = 0 THEN 'C' ELSE 'c' END || item AS codigo,
         'item ' || item || ' tam ' || label AS descricao,
         CASE WHEN report_type <> 'equipamentos' AND label % 7 <> 0 THEN 'u' || (label % 5) END AS unidade,
         CASE WHEN report_type = 'materiais' AND d <> 0 THEN p END AS preco_unitario,
         CASE WHEN report_type = 'equipamentos' THEN p * 10.0::DOUBLE END AS valor_aquisicao,
         CASE WHEN report_type = 'equipamentos' THEN t * 1000.0::DOUBLE END AS depreciacao,
         CASE WHEN report_type = 'equipamentos' THEN n * 0.25::DOUBLE END AS oportunidade_capital,
         CASE WHEN report_type = 'equipamentos' THEN t * 100.0::DOUBLE END AS seguros_impostos,
         CASE WHEN report_type = 'equipamentos' THEN d * 500.0::DOUBLE END AS manutencao,
         CASE WHEN report_type = 'equipamentos' THEN n * 2.0::DOUBLE END AS operacao,
         CASE WHEN report_type = 'equipamentos' AND d <> 0 THEN d * 80.0::DOUBLE END AS mao_de_obra_operacao,
         CASE WHEN report_type = 'equipamentos' THEN p END AS custo_produtivo,
         CASE WHEN report_type = 'equipamentos' THEN p * 0.5::DOUBLE END AS custo_improdutivo,
         CASE WHEN report_type = 'mao_de_obra' AND y < 2000 AND d <> 0 THEN n END AS salario,
         CASE WHEN report_type = 'mao_de_obra' AND y < 2000 THEN t * 10.0::DOUBLE END AS encargos_totais,
         CASE WHEN report_type = 'mao_de_obra' THEN p END AS custo,
         CASE WHEN report_type = 'mao_de_obra' AND y < 2000 THEN d * 10.0::DOUBLE END AS periculosidade_insalubridade,
         region || '/' || state_slug || '/' || y || '/' || month || '/' || state_slug || '-' || month || '-' || y
           || '/Relatório Sintético de ' || report_name || CASE WHEN desonerado THEN ' - com desoneração' ELSE '' END
           || CASE WHEN revisado THEN ' - revisado' ELSE '' END || '.xlsx' AS blob_name,
         region, state_slug, y::VARCHAR AS year, month, report_type, desonerado, revisado,
         state_slug || '-' || month || '-' || y AS archive_stem,
         strftime(make_timestamp(y, q * 3 - 2, 1, n_nationkey % 24, 0, 0.0)
           + to_days(CASE WHEN revisado THEN 85 ELSE 40 END), '%Y-%m-%d %H:%M:%S') AS parsed_at
  FROM (SELECT *, unnest(range(CASE WHEN item % 13 = 0 THEN 3 ELSE 1 END)) AS copy FROM s_rows)""")

# ---- staging --------------------------------------------------------------------------

_ITEM = "lower(codigo) AS codigo, upper(descricao[1]) || lower(descricao[2:]) AS descricao"
_FILE = """report_type, desonerado, revisado, region, state_slug, year::INTEGER AS year, month, archive_stem,
         blob_name, parsed_at::TIMESTAMP AS parsed_at"""
MAT = ["preco_unitario"]
EQU = ["valor_aquisicao", "depreciacao", "oportunidade_capital", "seguros_impostos", "manutencao", "operacao",
       "mao_de_obra_operacao", "custo_produtivo", "custo_improdutivo"]
LAB = ["salario", "encargos_totais", "custo", "periculosidade_insalubridade"]
cte("t_mat", f"SELECT {_ITEM}, unidade, preco_unitario, {_FILE} FROM s_panel WHERE report_type = 'materiais'")
cte("t_equ", f"SELECT {_ITEM}, {', '.join(EQU)}, {_FILE} FROM s_panel WHERE report_type = 'equipamentos'")
cte("t_lab", f"""
  SELECT {_ITEM}, unidade, {', '.join(LAB)},
         if(salario IS NULL, '2025_plus', 'pre_2025') AS schema_version, {_FILE}
  FROM s_panel WHERE report_type = 'mao_de_obra'""")

# ---- marts -----------------------------------------------------------------------------


def fact_sql(tipo: str, staged: str, key: str, partition: list[str], columns: list[str]) -> str:
    keys = ", ".join(partition)
    return f"""
  SELECT md5(concat_ws('|', '{tipo}', codigo, {keys})) AS {key}, md5('{tipo}|' || codigo) AS insumo_id,
         state_slug, make_date(year, month_number, 1) AS period_start, {', '.join(columns)},
         revisado, blob_name, parsed_at
  FROM (SELECT *, bool_or(revisado) OVER (PARTITION BY {keys}) AS has_revision FROM (SELECT DISTINCT * FROM {staged}))
       LEFT JOIN s_months ON month = month_name
  WHERE revisado = has_revision"""


P3, _P4 = ["state_slug", "year", "month"], ["state_slug", "year", "month", "desonerado"]
cte("f_mat", fact_sql("materiais", "t_mat", "preco_material_id", P3, MAT))
cte("f_equ", fact_sql("equipamentos", "t_equ", "custo_equipamento_id", _P4, ["desonerado"] + EQU))
cte("f_lab", fact_sql("mao_de_obra", "t_lab", "custo_mao_de_obra_id", _P4, ["desonerado"] + LAB + ["schema_version"]))


def _long(fact: str, key: str, regime: str, measures: list[str]) -> str:
    return "\n  UNION ALL ".join(
        f"SELECT {key} AS fato_id, insumo_id, state_slug, period_start, {regime} AS desonerado, '{m}' AS medida, "
        f"{m} AS valor, revisado, blob_name, parsed_at FROM {fact} WHERE {m} IS NOT NULL" for m in measures)


cte("f_all", "\n  UNION ALL ".join([
    _long("f_mat", "preco_material_id", "false", MAT),
    _long("f_equ", "custo_equipamento_id", "desonerado", EQU),
    _long("f_lab", "custo_mao_de_obra_id", "desonerado", LAB)]))
cte("f_long", "SELECT md5(fato_id || '|' || medida) AS medicao_id, * EXCLUDE (fato_id) FROM f_all")
cte("d_seen", """
  SELECT 'materiais' AS tipo, codigo, descricao, unidade, parsed_at FROM t_mat
  UNION ALL SELECT 'equipamentos', codigo, descricao, NULL::VARCHAR, parsed_at FROM t_equ
  UNION ALL SELECT 'mao_de_obra', codigo, descricao, unidade, parsed_at FROM t_lab""")
cte("d_item", """
  SELECT md5(tipo || '|' || codigo) AS insumo_id, tipo, codigo,
         last(descricao ORDER BY parsed_at, descricao) FILTER (descricao IS NOT NULL) AS descricao,
         last(unidade ORDER BY parsed_at, unidade) FILTER (unidade IS NOT NULL) AS unidade
  FROM d_seen GROUP BY tipo, codigo""")
cte("d_period", """
  SELECT DISTINCT make_date(year, month_number, 1) AS period_start, year AS ano, month AS mes,
         month_number AS mes_numero, (month_number - 1)::DOUBLE / 3 + 1 AS trimestre
  FROM (SELECT year, month FROM t_mat UNION SELECT year, month FROM t_equ UNION SELECT year, month FROM t_lab)
       LEFT JOIN s_months ON month = month_name""")

# ---- views -------------------------------------------------------------------------------

_SERIES = "PARTITION BY insumo_id, state_slug, desonerado, medida"
cte("v_current", f"""
  SELECT tipo, codigo, descricao, unidade, medida, valor, desonerado, state_slug, state_code, state_name, region,
         period_start
  FROM (SELECT * FROM f_long QUALIFY row_number() OVER ({_SERIES} ORDER BY period_start DESC) = 1)
       JOIN d_item USING (insumo_id) JOIN s_states USING (state_slug)""")
cte("v_changes", f"""
  SELECT *, lag(period_start) OVER series AS period_start_anterior, lag(valor) OVER series AS valor_anterior
  FROM f_long WINDOW series AS ({_SERIES} ORDER BY period_start)""")
cte("v_evolution", """
  SELECT tipo, codigo, descricao, medida, state_slug, state_name, desonerado, period_start, valor,
         period_start_anterior, valor_anterior, valor - valor_anterior AS variacao_absoluta,
         if(valor_anterior <> 0, (valor - valor_anterior) / valor_anterior, NULL) AS variacao_percentual
  FROM v_changes JOIN d_item USING (insumo_id) JOIN s_states USING (state_slug)""")
cte("v_sides", """
  SELECT insumo_id, state_slug, period_start, medida, unnest(d) AS a, n
  FROM (SELECT insumo_id, state_slug, period_start, medida, list(valor) FILTER (desonerado) AS d, list(valor) FILTER (NOT desonerado) AS n
        FROM f_long WHERE period_start IS NOT NULL GROUP BY ALL)
  WHERE d IS NOT NULL AND n IS NOT NULL""")
cte("v_regime", """
  SELECT tipo, codigo, descricao, medida, state_slug, state_name, period_start, a AS valor_desonerado,
         b AS valor_nao_desonerado, a - b AS diferenca_absoluta, if(b <> 0, (a - b) / b, NULL) AS diferenca_percentual
  FROM (SELECT * EXCLUDE (n), unnest(n) AS b FROM v_sides) JOIN d_item USING (insumo_id) JOIN s_states USING (state_slug)""")
cte("v_states", """
  SELECT tipo, codigo, descricao, medida, desonerado, state_slug, state_code, state_name, region, period_start, valor
  FROM f_long JOIN d_item USING (insumo_id) JOIN s_states USING (state_slug)""")
cte("v_base", """
  SELECT insumo_id, state_slug, desonerado, medida, arg_min(valor, period_start) AS valor_base
  FROM f_long GROUP BY ALL""")
cte("v_index", """
  SELECT tipo, state_slug, desonerado, period_start, 100 * median(valor / valor_base) AS indice, count(*) AS n_insumos
  FROM f_long JOIN v_base USING (insumo_id, state_slug, desonerado, medida) JOIN d_item USING (insumo_id)
  WHERE valor_base <> 0 GROUP BY tipo, state_slug, desonerado, period_start""")
cte("v_movers", """
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY tipo, state_slug
                ORDER BY abs(variacao_percentual) DESC, codigo, medida, desonerado) AS posicao
    FROM (SELECT * FROM v_evolution WHERE variacao_percentual IS NOT NULL
          QUALIFY period_start = max(period_start) OVER (PARTITION BY tipo, state_slug)))
  WHERE posicao <= 20""")
cte("v_equipment", f"""
  SELECT codigo, descricao, state_slug, state_name, region, period_start, desonerado, {', '.join(EQU)}
  FROM f_equ JOIN d_item USING (insumo_id) JOIN s_states USING (state_slug)""")
cte("v_labour", """
  SELECT codigo, descricao, unidade, state_slug, state_name, region, period_start, desonerado,
         salario, encargos_totais, periculosidade_insalubridade, custo, schema_version
  FROM f_lab JOIN d_item USING (insumo_id) JOIN s_states USING (state_slug)""")
cte("c_periods", """
  SELECT 'materiais' AS tipo, state_slug, period_start FROM f_mat
  UNION SELECT 'equipamentos', state_slug, period_start FROM f_equ
  UNION SELECT 'mao_de_obra', state_slug, period_start FROM f_lab""")
cte("c_expected", """
  SELECT tipo, s.state_slug, period_start
  FROM (SELECT DISTINCT tipo, period_start FROM c_periods), s_states s""")
cte("c_missing", """
  SELECT e.tipo, e.state_slug, e.period_start FROM c_expected e
  WHERE NOT EXISTS (FROM c_periods p WHERE (p.tipo, p.state_slug, p.period_start) = (e.tipo, e.state_slug, e.period_start))""")
cte("v_coverage", """
  SELECT tipo, state_slug, state_code, state_name, max(period_start) AS ultimo_periodo_disponivel,
         count(DISTINCT period_start) AS periodos_disponiveis,
         (SELECT count(*) FROM c_missing m WHERE m.tipo = p.tipo AND m.state_slug = p.state_slug)
           AS periodos_faltantes_vs_pares
  FROM c_periods p JOIN s_states USING (state_slug) GROUP BY tipo, state_slug, state_code, state_name""")

for _key, _from in {
    "stg_materiais": "t_mat", "stg_equipamentos": "t_equ", "stg_mao_de_obra": "t_lab",
    "dim_uf": "s_states", "dim_data_referencia": "d_period", "dim_insumo": "d_item",
    "fato_preco_material": "f_mat", "fato_custo_equipamento": "f_equ", "fato_custo_mao_de_obra": "f_lab",
    "fato_medicao": "f_long",
    "vw_preco_atual": "v_current", "vw_evolucao_preco": "v_evolution", "vw_comparacao_regime": "v_regime",
    "vw_comparacao_uf": "v_states", "vw_indice_reajuste": "v_index", "vw_maiores_variacoes": "v_movers",
    "vw_breakdown_equipamento": "v_equipment", "vw_breakdown_mao_de_obra": "v_labour", "vw_cobertura": "v_coverage",
    "cobertura_esperada": "c_expected", "cobertura_faltantes": "c_missing", "serie_base": "v_base",
}.items():
    oracle(_key, f"SELECT * FROM {_from}")
