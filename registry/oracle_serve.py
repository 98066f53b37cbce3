"""DuckDB SQL of operators, quality, incremental refresh, serving and formats."""

from __future__ import annotations

from pricelattice.plans.build import MART_NAMES, VIEW_NAMES
from registry.oracle import EQU, LAB, MAT, ORACLE, cte, oracle
from registry.lake import CUTOFF
from registry.serve import EQUIPMENT, LABOUR, MATERIAL, STATE_NAME, STATE_NAMES, STATE_SLUG

# Display labels, as in vocabulary.py.
_MEASURE = {
    "preco_unitario": "Preço Unitário", "custo_produtivo": "Custo Produtivo", "custo_improdutivo": "Custo Improdutivo",
    "valor_aquisicao": "Valor de Aquisição", "depreciacao": "Depreciação",
    "oportunidade_capital": "Oportunidade de Capital", "seguros_impostos": "Seguros e Impostos",
    "manutencao": "Manutenção", "operacao": "Operação", "mao_de_obra_operacao": "Mão de Obra de Operação",
    "salario": "Salário", "encargos_totais": "Encargos Totais", "custo": "Custo",
    "periculosidade_insalubridade": "Periculosidade e Insalubridade",
}
_MONTHS = ["Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro"]


def label(c: str) -> str:
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _MEASURE.items()) + f" ELSE {c} END"


def money(c: str) -> str:
    return f"'R$ ' || translate(format('{{:,.2f}}', {c}), ',.', '.,')"


def period(c: str) -> str:
    return f"{_MONTHS}[month({c})] || '/' || year({c})"


def change(c: str) -> str:
    return f"coalesce(replace(printf('%+.1f%%', {c} * 100), '.', ','), '—')"


def difference(c: str) -> str:
    return f"coalesce(replace(printf('%.1f%%', {c} * 100), '.', ','), '-')"


def mean(c: str) -> str:
    return f"sum({c}::DECIMAL(28,8))::DOUBLE / count({c})"


# Region and regime labels, as in vocabulary.py.
_SIM = "if({0}, 'Sim', 'Não')".format
_REGIME = "CASE WHEN {0} THEN 'Desonerado' WHEN NOT {0} THEN 'Não Desonerado' END".format
_REGION = "CASE {0} WHEN 'centro-oeste' THEN 'Centro-Oeste' WHEN 'nordeste' THEN 'Nordeste' WHEN 'norte' THEN 'Norte' WHEN 'sudeste' THEN 'Sudeste' WHEN 'sul' THEN 'Sul' ELSE {0} END".format
_NAMES = "(" + ", ".join(f"'{n}'" for n in STATE_NAMES) + ")"

# ---- operators -----------------------------------------------------------------------------

oracle("regime_filter", "SELECT medicao_id, valor, if(desonerado, 'd', 'n') AS regime FROM f_long")
oracle("guarded_ratio", "SELECT custo_equipamento_id, (depreciacao - manutencao) / nullif(manutencao, 0) AS ratio FROM f_equ")
# report type: staged rows, partition keys, headline measure
_TYPES = {
    "materiais": ("t_mat", "state_slug, year, month", "preco_unitario"),
    "equipamentos": ("t_equ", "state_slug, year, month, desonerado", "custo_produtivo"),
    "mao_de_obra": ("t_lab", "state_slug, year, month, desonerado", "custo"),
}


def _each(part: str) -> str:
    """The statement for every report type; {tipo}, {rows}, {keys}, {value} and {regime} stand for its own."""
    return "\nUNION ALL\n".join(
        part.format(tipo=t, rows=rows, keys=keys, value=value, regime="desonerado" if "desonerado" in keys else "false")
        for t, (rows, keys, value) in _TYPES.items()
    )


oracle("join_month_left", _each("""
SELECT '{tipo}' AS tipo, codigo, blob_name, year, m AS month, month_number AS mes_numero, make_date(year, month_number, 1) AS period_start
FROM (SELECT *, if(len(codigo) % 3 = 0, month || '?', month) AS m FROM {rows}) LEFT JOIN s_months ON m = month_name"""))
oracle("dedup_exact_rows", _each(
    "SELECT '{tipo}' AS tipo, codigo, blob_name, {value} AS valor, parsed_at FROM (SELECT DISTINCT * FROM {rows})"))
oracle("revisado_resolve", _each("""
SELECT * FROM (SELECT '{tipo}' AS tipo, state_slug, year, month, codigo, {value} AS valor, revisado, blob_name FROM {rows}
QUALIFY revisado = bool_or(revisado) OVER (PARTITION BY {keys}))"""))
oracle("latest_period_filter", """
SELECT medida, state_slug, insumo_id, desonerado, period_start, valor FROM f_long
QUALIFY period_start = max(period_start) OVER (PARTITION BY medida, state_slug)""")

# ---- incremental ---------------------------------------------------------------------------

_RESOLVED = """
  SELECT * FROM (SELECT '{tipo}' AS tipo, md5(concat_ws('|', '{tipo}', codigo, {keys})) AS fato_id,
         make_date(year, month_number, 1) AS period_start, {value} AS valor, revisado, parsed_at
  FROM (SELECT DISTINCT * FROM {rows} WHERE """
_RESOLVED_END = """) JOIN s_months ON month = month_name
  QUALIFY revisado = bool_or(revisado) OVER (PARTITION BY {keys}))"""
cte("n_old", _each(_RESOLVED + f"parsed_at <= TIMESTAMP '{CUTOFF}'" + _RESOLVED_END))
cte("n_mark", _each("""
  SELECT '{tipo}' AS tipo, coalesce(max(parsed_at), TIMESTAMP '1900-01-01') AS high_water_mark FROM n_old WHERE tipo = '{tipo}'"""))
cte("n_batch", _each(_RESOLVED + """({keys}) IN (
    SELECT ({keys}) FROM {rows} WHERE parsed_at > (SELECT high_water_mark FROM n_mark WHERE tipo = '{tipo}'))""" + _RESOLVED_END))
oracle("high_water_mark", "SELECT tipo, high_water_mark FROM n_mark")
oracle("changed_partitions", f"""
SELECT DISTINCT 'materiais' AS tipo, state_slug, year, month, NULL::BOOLEAN AS desonerado FROM t_mat WHERE parsed_at > TIMESTAMP '{CUTOFF}'
UNION ALL SELECT DISTINCT 'equipamentos', state_slug, year, month, desonerado FROM t_equ WHERE parsed_at > TIMESTAMP '{CUTOFF}'
UNION ALL SELECT DISTINCT 'mao_de_obra', state_slug, year, month, desonerado FROM t_lab WHERE parsed_at > TIMESTAMP '{CUTOFF}'""")
oracle("incremental_batch", "SELECT * FROM n_batch")
oracle("delete_insert", "SELECT * FROM n_batch UNION ALL SELECT * FROM n_old WHERE fato_id NOT IN (SELECT fato_id FROM n_batch)")
# the whole partitions (state, month, for other types than materials also regime) of the batch replace the old ones
cte("n_new", _each(_RESOLVED.replace("AS fato_id,", "AS fato_id, state_slug, {regime} AS regime,") + """({keys}) IN (
    SELECT ({keys}) FROM {rows} WHERE parsed_at > (SELECT high_water_mark FROM n_mark WHERE tipo = '{tipo}'))""" + _RESOLVED_END))
cte("n_was", _each(_RESOLVED.replace("AS fato_id,", "AS fato_id, state_slug, {regime} AS regime,") + f"parsed_at <= TIMESTAMP '{CUTOFF}'" + _RESOLVED_END))
oracle("partition_overwrite", """
SELECT tipo, fato_id, period_start, valor, revisado, parsed_at FROM n_new
UNION ALL SELECT tipo, fato_id, period_start, valor, revisado, parsed_at
FROM n_was ANTI JOIN n_new USING (tipo, state_slug, period_start, regime)""")

oracle("catalog_relations", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS relation, count(*) AS n FROM ({ORACLE[name]})" for name in MART_NAMES + VIEW_NAMES))

# ---- quality ---------------------------------------------------------------------------------

oracle("check_not_null", "SELECT preco_material_id FROM f_mat WHERE preco_unitario IS NULL")
oracle("check_unique", "SELECT insumo_id, count(*) AS n FROM f_long GROUP BY insumo_id HAVING count(*) > 1")
oracle("check_accepted_values", "SELECT custo_mao_de_obra_id FROM f_lab WHERE schema_version NOT IN ('pre_2025')")
oracle("check_valor_positivo", """
SELECT medicao_id, medida, 0::DOUBLE AS valor FROM f_long
WHERE valor < 5000 AND medida IN ('preco_unitario', 'custo_produtivo', 'custo_improdutivo', 'custo')""")
oracle("warn_cobertura", "SELECT * FROM v_coverage WHERE periodos_faltantes_vs_pares > 0")
oracle("warn_variacao", "SELECT * FROM v_evolution WHERE abs(variacao_percentual) > 0.3")


def _nulls(name: str, table: str, column: str) -> str:
    return f"SELECT 'not_null_{name}_{column}' AS check_name, 'error' AS severity, count(*) AS violations FROM {table} WHERE {column} IS NULL"


def _dups(name: str, table: str, column: str) -> str:
    return f"SELECT 'unique_{name}_{column}', 'error', count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"


def _listed(name: str, table: str, column: str, values: str) -> str:
    return f"SELECT 'accepted_values_{name}_{column}', 'error', count(*) FROM {table} WHERE {column} NOT IN ({values})"


_KEYED = {
    "dim_uf": ("s_states", "state_slug"), "dim_data_referencia": ("d_period", "period_start"),
    "dim_insumo": ("d_item", "insumo_id"), "fato_preco_material": ("f_mat", "preco_material_id"),
    "fato_custo_equipamento": ("f_equ", "custo_equipamento_id"),
    "fato_custo_mao_de_obra": ("f_lab", "custo_mao_de_obra_id"), "fato_medicao": ("f_long", "medicao_id"),
}
_LAYOUTS = "'pre_2025', '2025_plus'"
oracle("quality_report", "\nUNION ALL ".join(
    [_nulls(n, t, c) for n, t in [("stg_materiais", "t_mat"), ("stg_equipamentos", "t_equ"), ("stg_mao_de_obra", "t_lab")] for c in ["codigo", "blob_name"]]
    + [f(n, t, c) for n, (t, c) in _KEYED.items() for f in (_nulls, _dups)]
    + [_nulls("dim_insumo", "d_item", "codigo"), _nulls("fato_medicao", "f_long", "valor")]
    + [_nulls(n, _KEYED[n][0], "insumo_id") for n in _KEYED if n.startswith("fato")]
    + [_listed("dim_insumo", "d_item", "tipo", "'materiais', 'equipamentos', 'mao_de_obra'"),
       _listed("stg_mao_de_obra", "t_lab", "schema_version", _LAYOUTS),
       _listed("fato_custo_mao_de_obra", "f_lab", "schema_version", _LAYOUTS)]
    + ["SELECT 'valor_positivo', 'error', count(*) FROM f_long WHERE valor < 0 OR valor = 0 AND medida IN ('preco_unitario', 'custo_produtivo', 'custo_improdutivo', 'custo')",
       "SELECT 'warn_cobertura_com_lacunas', 'warn', count(*) FROM v_coverage WHERE periodos_faltantes_vs_pares > 0",
       "SELECT 'warn_variacao_percentual_suspeita', 'warn', count(*) FROM v_evolution WHERE abs(variacao_percentual) > 0.3"]))

# ---- serving -----------------------------------------------------------------------------------

oracle("serve_preco_atual", f"SELECT * FROM v_current WHERE tipo = 'equipamentos' AND state_name = '{STATE_NAME}' AND NOT desonerado")
oracle("serve_evolucao_uf", f"""
SELECT tipo, codigo, e.descricao, medida, state_name, desonerado, period_start, valor, variacao_percentual, unidade
FROM v_evolution e JOIN d_item USING (tipo, codigo)
WHERE tipo = 'mao_de_obra' AND state_name = '{STATE_NAME}' AND codigo = '{LABOUR}'""")
cte("g_mean", f"""
  SELECT tipo, codigo, e.descricao, medida, desonerado, period_start, {mean('valor')} AS valor, unidade
  FROM v_evolution e JOIN d_item USING (tipo, codigo)
  WHERE tipo = 'equipamentos' AND codigo = '{EQUIPMENT}' GROUP BY ALL""")
oracle("serve_evolucao_media", """
SELECT * EXCLUDE (before), 'Todas as UFs' AS state_name,
       CASE WHEN before = 0 THEN CASE WHEN valor > 0 THEN 'inf'::DOUBLE WHEN valor < 0 THEN '-inf'::DOUBLE ELSE 'nan'::DOUBLE END
            ELSE valor / before - 1 END AS variacao_percentual
FROM (SELECT *, lag(valor) OVER (PARTITION BY medida, desonerado ORDER BY period_start) AS before FROM g_mean)""")
cte("g_item", f"SELECT * FROM v_current WHERE tipo = 'equipamentos' AND codigo = '{EQUIPMENT}' AND medida = 'custo_produtivo'")
cte("g_here", f"SELECT min(valor) AS lo, max(valor) AS hi FROM g_item WHERE state_name = '{STATE_NAME}'")
cte("g_last", f"""
  SELECT variacao_percentual AS v FROM v_evolution
  WHERE tipo = 'equipamentos' AND codigo = '{EQUIPMENT}' AND medida = 'custo_produtivo' AND state_name = '{STATE_NAME}'
  ORDER BY period_start DESC, desonerado DESC LIMIT 1""")
oracle("serve_kpis", f"""
SELECT codigo, descricao, unidade, {mean('valor')} AS preco_medio, min(valor) AS menor_preco,
       first(state_name ORDER BY valor, state_name) AS menor_preco_uf, max(valor) AS maior_preco,
       first(state_name ORDER BY valor DESC, state_name) AS maior_preco_uf, max(period_start) AS publicacao,
       (SELECT lo FROM g_here) AS preco_uf_min, (SELECT hi FROM g_here) AS preco_uf_max,
       {period('max(period_start)')} AS publicacao_rotulo,
       (SELECT CASE WHEN lo IS NULL THEN '—' ELSE {money('lo')} || CASE WHEN lo < hi THEN ' – ' || {money('hi')} ELSE '' END END FROM g_here)
         AS preco_atual,
       coalesce((SELECT {change('v')} FROM g_last), '—') AS variacao
FROM g_item GROUP BY codigo, descricao, unidade""")
oracle("serve_preco_por_estado", f"""
SELECT codigo, state_name, desonerado, {_REGIME('desonerado')} AS regime, valor, {money('valor')} AS valor_rotulo, unidade FROM g_item""")
cte("g_regime", f"SELECT * FROM v_regime WHERE tipo = 'equipamentos' AND codigo = '{EQUIPMENT}'")
cte("g_regime_last", "SELECT * FROM g_regime WHERE period_start = (SELECT max(period_start) FROM g_regime)")
oracle("serve_regime", f"""
SELECT codigo, medida, state_name, period_start, valor_desonerado, valor_nao_desonerado, diferenca_percentual
FROM g_regime WHERE state_name IN {_NAMES}""")
oracle("serve_regime_media", f"""
SELECT {label('medida')} AS medida, regime, valor_medio, {money('valor_medio')} AS rotulo FROM (
  SELECT medida, 'Não Desonerado' AS regime, {mean('valor_nao_desonerado')} AS valor_medio FROM g_regime_last GROUP BY medida
  UNION ALL SELECT medida, 'Desonerado', {mean('valor_desonerado')} FROM g_regime_last GROUP BY medida)""")
oracle("serve_regime_tabela", f"""
SELECT {label('medida')} AS "Medida", state_name AS "UF", {money('valor_nao_desonerado')} AS "Não Desonerado",
       {money('valor_desonerado')} AS "Desonerado", {difference('diferenca_percentual')} AS "Diferença" FROM g_regime_last""")
oracle("serve_comparacao_uf", f"""
SELECT medida, desonerado, state_name, {_REGION('region')} AS region, period_start, valor, {_SIM('desonerado')} AS desonerado_rotulo,
       {money('valor')} AS rotulo
FROM v_states WHERE codigo = '{EQUIPMENT}' AND medida = 'custo_produtivo'
QUALIFY period_start = max(period_start) OVER ()""")
oracle("serve_indice", f"""
SELECT state_slug, desonerado, period_start, indice, n_insumos, state_name,
       state_name || if(desonerado, ' (desonerado)', ' (não desonerado)') AS serie, {period('period_start')} AS publicacao,
       replace(printf('%.1f', indice), '.', ',') AS indice_rotulo
FROM v_index JOIN s_states USING (state_slug) WHERE tipo = 'equipamentos' AND state_name IN {_NAMES}""")


def _movers(where: str) -> str:
    return f"""
  SELECT codigo, descricao, medida, state_name, period_start, valor, valor_anterior, variacao_percentual,
         row_number() OVER (ORDER BY abs(variacao_percentual) DESC, codigo, state_name, desonerado) AS posicao
  FROM (SELECT * FROM v_evolution WHERE variacao_percentual IS NOT NULL AND {where}
        QUALIFY period_start = max(period_start) OVER (PARTITION BY state_slug))
  QUALIFY posicao <= 20"""


oracle("serve_top20_regional", f"SELECT * FROM ({_movers('''tipo = 'equipamentos' AND medida = 'custo_produtivo' AND NOT desonerado AND state_slug IN (SELECT state_slug FROM s_states WHERE region = 'africa')''')})")
oracle("serve_top20_tabela", f"""
SELECT codigo AS "Código", descricao AS "Descrição", {label('medida')} AS "Medida", state_name AS "UF",
       {period('period_start')} AS "Publicação", {money('valor_anterior')} AS "Valor Anterior", {money('valor')} AS "Valor Atual",
       {change('variacao_percentual')} AS "Variação"
FROM ({_movers("tipo = 'materiais' AND medida = 'preco_unitario'")})""")
cte("g_equ", f"SELECT * FROM v_equipment WHERE codigo = '{EQUIPMENT}' AND state_slug = '{STATE_SLUG}'")
cte("g_lab", f"SELECT * FROM v_labour WHERE codigo = '{LABOUR}' AND state_slug = '{STATE_SLUG}'")
oracle("serve_detalhe_equip", "\nUNION ALL ".join(
    f"SELECT codigo, state_slug, period_start, desonerado, custo_produtivo, custo_improdutivo, '{_MEASURE[m]}' AS componente, {m} AS valor, {money(m)} AS rotulo FROM g_equ"
    for m in EQU[:7]))
oracle("serve_detalhe_mao", "\nUNION ALL ".join(
    f"SELECT codigo, state_slug, period_start, desonerado, custo, '{_MEASURE[m]}' AS componente, {m} AS valor, {money(m)} AS rotulo FROM g_lab WHERE schema_version = 'pre_2025'"
    for m in LAB if m != "custo"))
_HEAD = f"""state_name AS "UF", {_REGION('region')} AS "Região", {period('period_start')} AS "Publicação", {_SIM('desonerado')} AS "Desonerado" """
oracle("serve_detalhe_equip_tabela", f"""
SELECT codigo AS "Código", descricao AS "Descrição", {_HEAD},
       {', '.join(f'{money(m)} AS "{_MEASURE[m]}"' for m in EQU)} FROM g_equ""")
oracle("serve_detalhe_mao_tabela", f"""
SELECT codigo AS "Código", descricao AS "Descrição", coalesce(unidade, '—') AS "Unidade", {_HEAD},
       {', '.join(f"""coalesce({money(m)}, '—') AS "{'Custo Final' if m == 'custo' else _MEASURE[m]}" """ for m in LAB)},
       if(schema_version = 'pre_2025', 'Até 2025', '2025 em diante') AS "Layout" FROM g_lab""")
oracle("serve_cobertura", """
SELECT tipo, state_name, ultimo_periodo_disponivel, periodos_disponiveis, periodos_faltantes_vs_pares FROM v_coverage""")
oracle("serve_cobertura_resumo", "SELECT count(*) FILTER (periodos_faltantes_vs_pares > 0) AS com_lacuna, count(*) AS combinacoes FROM v_coverage")
oracle("serve_periodo_span", f"""
SELECT inicio, fim, {period('inicio')} AS inicio_rotulo, {period('fim')} AS fim_rotulo
FROM (SELECT min(period_start) AS inicio, max(period_start) AS fim FROM d_period)""")
oracle("list_ufs", "SELECT * FROM s_states")
oracle("list_insumos", "SELECT codigo, descricao FROM d_item")
oracle("list_medidas", f"SELECT DISTINCT medida, {label('medida')} AS rotulo FROM v_evolution WHERE tipo = 'equipamentos' AND codigo = '{EQUIPMENT}'")
oracle("list_periodos", f"SELECT DISTINCT period_start, {period('period_start')} AS rotulo FROM g_equ")
oracle("serve_single_item_guard", f"SELECT 'codigo' AS filtro, codigo, state_slug, medida, valor FROM v_current WHERE codigo = '{MATERIAL}'")

# ---- formats -------------------------------------------------------------------------------------

oracle("labels", f"""
SELECT codigo, state_slug, period_start,
       CASE tipo WHEN 'materiais' THEN 'Materiais' WHEN 'equipamentos' THEN 'Equipamentos' ELSE 'Mão de Obra' END AS tipo,
       {label('medida')} AS medida, {_REGION('region')} AS regiao, {_SIM('desonerado')} AS sim_nao, {_REGIME('desonerado')} AS regime
FROM v_states""")
oracle("format_periodo", f"SELECT medicao_id, {period('period_start')} AS rotulo FROM f_long")
oracle("format_moeda", f"SELECT medicao_id, {money('valor')} AS rotulo FROM f_long")
oracle("format_faixa", f"SELECT custo_equipamento_id, {money('custo_improdutivo')} || ' – ' || {money('custo_produtivo')} AS rotulo FROM f_equ")
oracle("format_variacao", f"""
SELECT codigo, medida, state_slug, desonerado, period_start, {change('variacao_percentual')} AS variacao,
       {difference('variacao_percentual')} AS diferenca FROM v_evolution""")
