"""DuckDB SQL of the ingestion queries."""

from __future__ import annotations

from registry.oracle import EQU, LAB, MAT, cte, oracle

_PARTS = "report_type, desonerado, year::INTEGER AS year, month, state_slug"

_ALL = MAT + EQU + LAB
oracle("scan_union_by_name", f"SELECT codigo, blob_name, year, report_type, {', '.join(_ALL)} FROM s_panel")
oracle("sink_silver_partitioned", f"SELECT codigo, blob_name, {_PARTS}, {', '.join(LAB)} FROM s_panel")
oracle("scan_hive_partitions", f"SELECT {_PARTS}, count(*) AS n FROM s_panel GROUP BY ALL")
oracle("file_id_replace", """
SELECT report_type AS tipo, blob_name, codigo, revisado, CASE WHEN revisado THEN 2 ELSE 1 END
  * CASE report_type WHEN 'materiais' THEN preco_unitario WHEN 'equipamentos' THEN custo_produtivo ELSE custo END AS valor FROM s_panel""")
oracle("gold_export_roundtrip", "SELECT * FROM v_states")
oracle("gold_export_clustered", "SELECT * FROM v_evolution WHERE tipo = 'equipamentos' AND medida = 'custo_produtivo'")
oracle("seed_month_lookup", """
SELECT month, n, month_number AS mes_numero
FROM (SELECT month, count(*) AS n FROM s_panel GROUP BY month) JOIN s_months ON month = month_name""")
oracle("content_sha256", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
# ---- files -----------------------------------------------------------------------------------

cte("i_real", "SELECT DISTINCT blob_name AS path FROM s_panel")
cte("i_paths", """
  SELECT path FROM i_real
  UNION ALL SELECT replace(path, 'Sintético', 'Analítico') FROM i_real
  UNION ALL SELECT replace(path, '.xlsx', '.PDF') FROM i_real
  UNION ALL SELECT replace(replace(path, '.xlsx', '.XLSX'), 'ã', '╞') FROM i_real
  UNION ALL SELECT path.split('/')[-1] FROM i_real""")
cte("i_named", "SELECT path, lower(path.split('/')[-1]) AS name, path.split('/') AS parts FROM i_paths")
cte("i_reports", """
  SELECT path AS blob_name, parts[1] AS region, parts[2] AS state_slug, parts[3] AS year, parts[4] AS month,
         parts[5] AS archive_stem,
         CASE WHEN name LIKE '%materiais%' THEN 'materiais' WHEN name LIKE '%equipamentos%' THEN 'equipamentos'
              WHEN regexp_matches(name, 'm.{0,2}o\\s+de\\s+obra') THEN 'mao_de_obra' END AS report_type,
         regexp_matches(name, 'desonera.{0,2}o') AS desonerado, lower(path) LIKE '%revisado%' AS revisado
  FROM i_named WHERE len(parts) >= 6 AND name LIKE '%.xlsx' AND name LIKE '%relat%' AND name LIKE '%sint%'""")
oracle("classify_files", "SELECT * FROM i_reports WHERE report_type IS NOT NULL")
oracle("classify_regime", "SELECT path, regexp_matches(name, 'desonera.{0,2}o') AS desonerado FROM i_named")
oracle("classify_revised", "SELECT path, lower(path) LIKE '%revisado%' AS revisado FROM i_named")
oracle("raw_object_path", """
SELECT DISTINCT blob_name, region || '/' || state_slug || '/' || year || '/' || month || '/' || archive_stem || '/'
  || report_type || '.xlsx' AS destination FROM s_panel""")
oracle("silver_object_path", """
SELECT blob_name, format('silver/reports/report_type={}/desonerado={}/year={}/month={}/state_slug={}/{}.parquet',
  report_type, desonerado, year, month, state_slug, sha1(blob_name)[:16]) AS destination
FROM i_reports WHERE report_type IS NOT NULL""")

# ---- links -------------------------------------------------------------------------------------

cte("l_found", """
  SELECT page_id, url, unnest(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1)) AS href FROM pages""")
cte("l_resolved", """
  SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/]+/') AS site,
         regexp_extract(url, '^[a-z]+://[^/]+') || href AS link
  FROM l_found WHERE href LIKE '/%'""")
oracle("page_links", "SELECT page_id, href FROM l_found")
oracle("page_links_resolved", "SELECT page_id, link FROM l_resolved")
oracle("links_in_scope", """
SELECT page_id, link FROM l_resolved
WHERE starts_with(link, site) AND NOT contains(lower(link), '/the') AND NOT contains(lower(link), 'nicht')""")
oracle("links_distinct", "SELECT DISTINCT page_id, link FROM l_resolved")
oracle("links_file_or_page", "SELECT DISTINCT page_id, link, contains(link.split('/')[-1], '.') AS is_file FROM l_resolved")
oracle("url_metadata", """
SELECT page_id, url AS link, p[-1] AS filename, p[-5] AS region, p[-4] AS state_code, split_part(p[-3], '-', 1) AS year,
       split_part(p[-2], '-', 1) AS month, split_part(p[-1], '.', -1) AS extension,
       contains(lower(p[-1]), 'revisado') AS revisado
FROM (SELECT *, url.split('/') AS p FROM pages)""")
oracle("link_reachability", """
SELECT node, min(depth)::INTEGER AS depth FROM (
  WITH RECURSIVE edges AS (
    SELECT DISTINCT o_custkey AS src, (o_custkey * 7 + o_orderkey % 11) % (SELECT max(o_custkey) + 1 FROM orders) AS dst FROM orders),
  walk AS (SELECT r_regionkey::BIGINT AS node, 0 AS depth FROM region
           UNION SELECT dst, depth + 1 FROM walk JOIN edges ON src = node WHERE depth < 5)
  SELECT * FROM walk)
GROUP BY node""")

# ---- ledgers --------------------------------------------------------------------------------------

cte("o_status", """
  SELECT *, CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN 'failed' ELSE 'downloaded' END AS state
  FROM orders""")
cte("o_downloads", """
  SELECT o_orderkey AS id, 'r' || (o_custkey % 5) AS region, 's' || (o_custkey % 27) AS state_code,
         year(o_orderdate)::VARCHAR AS year, month(o_orderdate)::VARCHAR AS month, o_orderkey % 5 = 0 AS revisado,
         'https://prices.example/file/' || (o_orderkey - o_orderkey % 3) AS url, 'f' || o_orderkey || '.zip' AS filename,
         'zip' AS extension, CASE WHEN o_custkey % 3 <> 0 THEN o_orderdate END AS scraped_at,
         CASE WHEN state <> 'pending' AND o_orderkey % 5 >= 2 THEN o_orderdate + INTERVAL 1 DAY END AS downloaded_at,
         state AS status,
         CASE WHEN state = 'downloaded' AND o_orderkey % 4 <> 0 THEN md5(o_orderkey::VARCHAR) END AS file_hash
  FROM o_status""")
cte("o_first", "SELECT * FROM o_downloads WHERE id % 6 = 0")
cte("o_parses", """
  SELECT o_orderkey AS seq, 'raw/' || (o_orderkey - o_orderkey % 3) || '.xlsx' AS blob_name,
         ['materiais', 'equipamentos', 'mao_de_obra'][o_custkey % 3 + 1] AS report_type,
         CASE WHEN o_orderstatus <> 'F' THEN o_custkey % 100 END AS row_count,
         if(o_orderstatus <> 'F', 'parsed', 'failed') AS status,
         CASE WHEN o_orderstatus = 'F' THEN 'no known header in ' || o_orderkey END AS error, o_orderdate AS parsed_at
  FROM orders""")
cte("o_ledger", "SELECT * EXCLUDE (seq) FROM o_parses WHERE seq % 6 = 0")
oracle("ledger_insert_ignore", """
SELECT * FROM o_first
UNION ALL
(SELECT * FROM o_downloads WHERE url NOT IN (SELECT url FROM o_first)
 QUALIFY row_number() OVER (PARTITION BY url ORDER BY id) = 1)""")
oracle("ledger_pending", """
SELECT id, region, state_code, year, month, url, filename, extension FROM o_downloads
WHERE status <> 'downloaded' ORDER BY scraped_at NULLS FIRST, id""")
_REST = "l.id, l.region, l.state_code, l.year, l.month, l.revisado, l.url, l.filename, l.extension, l.scraped_at"


def _updated(ledger: str, updates: str, keys: list[str]) -> str:
    columns = ", ".join(keys)
    return f"""
WITH u AS (SELECT {columns}, last({{'s': status, 'h': file_hash}} ORDER BY id) AS c,
             last(downloaded_at ORDER BY id) FILTER (downloaded_at IS NOT NULL) AS at
           FROM {updates} GROUP BY {columns})
SELECT {_REST}, coalesce(u.at, l.downloaded_at) AS downloaded_at,
       CASE WHEN u.c IS NULL THEN l.status ELSE u.c.s END AS status,
       CASE WHEN u.c IS NULL THEN l.file_hash ELSE u.c.h END AS file_hash
FROM {ledger} l LEFT JOIN u ON {' AND '.join(f'l.{k} = u.{k}' for k in keys)}"""


_COMPOSITE = ["state_code", "year", "month", "revisado"]
cte("o_batch", "SELECT * FROM o_downloads WHERE id % 4 <> 1")
cte("o_failed", "SELECT * FROM o_downloads WHERE status = 'failed'")
oracle("ledger_update_by_key", f"SELECT * FROM ({_updated('o_first', 'o_batch', ['url'])})")
oracle("ledger_update_composite", f"SELECT * FROM ({_updated('o_downloads', 'o_failed', _COMPOSITE)})")
oracle("ledger_latest", """
SELECT state_code, year, month, revisado, status, filename, file_hash, downloaded_at FROM o_downloads
QUALIFY row_number() OVER (PARTITION BY state_code, year, month, revisado
                           ORDER BY downloaded_at DESC NULLS LAST, id DESC) = 1""")
oracle("ledger_upsert", """
SELECT coalesce(n.blob_name, l.blob_name) AS blob_name,
       CASE WHEN n.seq IS NULL THEN l.report_type ELSE n.report_type END AS report_type,
       CASE WHEN n.seq IS NULL THEN l.row_count ELSE n.row_count END AS row_count,
       CASE WHEN n.seq IS NULL THEN l.status ELSE n.status END AS status,
       CASE WHEN n.seq IS NULL THEN l.error ELSE n.error END AS error,
       CASE WHEN n.seq IS NULL THEN l.parsed_at ELSE n.parsed_at END AS parsed_at
FROM o_ledger l FULL JOIN (SELECT * FROM o_parses WHERE seq % 2 = 1
                           QUALIFY seq = max(seq) OVER (PARTITION BY blob_name)) n USING (blob_name)""")
oracle("pending_files", """
SELECT DISTINCT blob_name FROM o_parses
WHERE blob_name NOT IN (SELECT blob_name FROM o_ledger WHERE status = 'parsed')""")
oracle("pending_limited", """
SELECT DISTINCT blob_name FROM o_parses WHERE blob_name NOT IN (SELECT blob_name FROM o_ledger WHERE status = 'parsed')
ORDER BY blob_name LIMIT 100""")
oracle("failed_files", "SELECT blob_name, error FROM o_parses WHERE status = 'failed'")

# ---- sheets -------------------------------------------------------------------------------------------

# Header cells of the report layouts, as in vocabulary.py.
_HEADERS = {
    "materiais": ["Código", "Descrição", "Unidade", "Preço Unitário (R$)"],
    "equipamentos": [
        "Código", "Descrição", "Valor de Aquisição (R$)", "Depreciação (R$/h)", "Oportunidade de Capital (R$/h)",
        "Seguros e Impostos (R$/h)", "Manutenção (R$/h)", "Operação (R$/h)", "Mão de Obra de Operação (R$/h)",
        "Custo Produtivo (R$/h)", "Custo Improdutivo (R$/h)"],
    "old": ["Código", "Descrição", "Unidade", "Salário (R$)", "Encargos Totais", "Custo (R$)", "Periculosidade/ Insalubridade"],
    "new": ["Código", "Descrição", "Unidade", "Custo (R$)"],
}


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def _number(column: str, broken: bool = False) -> str:
    text = f"coalesce({column}::DECIMAL(18,4)::VARCHAR, ' - ')"
    return f"if(broken, 'n/d', {text})" if broken else text


# normalised cells of a sheet row; the raw text differs from them in white space only
cte("h_rows", """
  SELECT *, codigo[2:]::BIGINT AS item, year = '1997' AND codigo[2:]::BIGINT % 97 = 5 AS broken,
         CASE WHEN report_type <> 'mao_de_obra' THEN report_type WHEN year < '2000' THEN 'old' ELSE 'new' END AS layout,
         upper(descricao) AS d
  FROM s_panel""")
cte("h_body", f"""
  SELECT blob_name AS file, report_type, layout, item * 4 + 10 AS row_idx,
         CASE layout
           WHEN 'materiais' THEN [codigo, d, unidade, trim({_number('preco_unitario', True)})]
           WHEN 'equipamentos' THEN [codigo, d, trim({_number('valor_aquisicao', True)}), {', '.join(
               'trim(' + _number(c) + ')' for c in ['depreciacao', 'oportunidade_capital', 'seguros_impostos', 'manutencao', 'operacao', 'mao_de_obra_operacao', 'custo_produtivo', 'custo_improdutivo'])}]
           WHEN 'old' THEN [codigo, d, unidade, trim({_number('salario')}), trim({_number('encargos_totais')}),
                            trim({_number('custo', True)}), trim({_number('periculosidade_insalubridade')})]
           ELSE [codigo, d, unidade, trim({_number('custo', True)})] END AS cells
  FROM h_rows""")
cte("h_files", "SELECT DISTINCT blob_name AS file, report_type, layout, state_slug, year, month, state_slug = 'nation_20' AND year = '1996' AS unknown FROM h_rows")
cte("h_head", f"""
  SELECT file, CASE layout {' '.join(f"WHEN '{k}' THEN {_list(v)}" for k, v in _HEADERS.items())} END AS names, unknown
  FROM h_files""")
cte("h_all", """
  SELECT file, row_idx, array_to_string(cells, '|') AS cells, cells[4] AS fourth FROM h_body
  UNION ALL SELECT file, 0, 'Tabela|Preços de referência', NULL FROM h_files
  UNION ALL SELECT file, 1, state_slug || ' - ' || month || '/' || year, NULL FROM h_files
  UNION ALL SELECT file, 2, array_to_string([if(unknown, 'Cod.', names[1])] || names[2:], '|'), names[4] FROM h_head
  UNION ALL SELECT file, 1::BIGINT << 40, 'fim', NULL FROM h_files""")
oracle("sheet_header_norm", "SELECT file, row_idx, cells FROM h_all")
cte("h_found", """
  SELECT file, 2::BIGINT AS header_idx, if(layout = 'new', 1, 0)::INTEGER AS layout FROM h_files WHERE NOT unknown""")
oracle("sheet_header_find", "SELECT * FROM h_found")
oracle("sheet_unknown_layout", "SELECT file, report_type FROM h_files WHERE unknown")
cte("h_raw", """
  SELECT file, row_idx, '  ' || cells[1] || chr(9) AS first,
         if(cells[4] = '-', ' - ', cells[4]) AS fourth
  FROM h_body""")
oracle("sheet_rows", """
SELECT file, row_idx, h_found.layout, first, fourth FROM h_raw JOIN h_found USING (file)""")
oracle("clean_numeric", """
SELECT file, row_idx, TRY_CAST(fourth AS DOUBLE) AS value,
       coalesce(fourth <> '-' AND TRY_CAST(fourth AS DOUBLE) IS NULL, false) AS bad FROM h_all""")
cte("h_bad", "SELECT DISTINCT blob_name AS file FROM h_rows WHERE broken")
_CELLS = ", ".join(f"CASE WHEN report_type = '{t}' THEN {m}::DECIMAL(18,4)::DOUBLE END AS {m}" for t, own in
                   (("materiais", MAT), ("equipamentos", EQU), ("mao_de_obra", LAB)) for m in own)
cte("h_good", """
  SELECT * FROM h_rows WHERE NOT (state_slug = 'nation_20' AND year = '1996') AND blob_name NOT IN (SELECT file FROM h_bad)""")
oracle("reject_bad_files", f"""
SELECT report_type AS tipo, blob_name AS file, item * 4 + 10 AS row_idx, lower(codigo) AS codigo, descricao, {_CELLS} FROM h_good""")
oracle("silver_from_sheets", f"""
SELECT lower(codigo) AS codigo, descricao, {_CELLS}, blob_name, region, state_slug, year, month, archive_stem, report_type, desonerado,
       revisado, '2002-01-01 00:00:00' AS parsed_at FROM h_good""")
cte("h_outcome", """
  SELECT f.file, report_type,
         CASE WHEN NOT unknown AND b.file IS NULL THEN (SELECT count(*) FROM h_body r WHERE r.file = f.file) END AS row_count,
         if(unknown OR b.file IS NOT NULL, 'failed', 'parsed') AS status,
         CASE WHEN unknown THEN 'no known header' WHEN b.file IS NOT NULL THEN 'cell is not a number' END AS error
  FROM h_files f LEFT JOIN h_bad b ON f.file = b.file""")
oracle("file_outcomes", "SELECT * FROM h_outcome")
oracle("file_row_counts", "SELECT file, row_count FROM h_outcome WHERE status = 'parsed'")
oracle("clean_text", r"""
SELECT doc_id, lower(trim(regexp_replace(coalesce(text, ''),
  '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))) AS text
FROM documents""")
