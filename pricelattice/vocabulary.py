"""Words, layouts and patterns of the published reports.

Everything here is a fixed value: it has to be spelled exactly like this for
files to be recognised and for results to carry the expected names.
"""

from __future__ import annotations

# ---- fixed values: report types and their measures --------------------------

MATERIAL = "materiais"
EQUIPMENT = "equipamentos"
LABOUR = "mao_de_obra"
REPORT_TYPES = [MATERIAL, EQUIPMENT, LABOUR]

MATERIAL_MEASURES = ["preco_unitario"]
EQUIPMENT_MEASURES = [
    "valor_aquisicao",
    "depreciacao",
    "oportunidade_capital",
    "seguros_impostos",
    "manutencao",
    "operacao",
    "mao_de_obra_operacao",
    "custo_produtivo",
    "custo_improdutivo",
]
LABOUR_MEASURES = ["salario", "encargos_totais", "custo", "periculosidade_insalubridade"]
MEASURES = {MATERIAL: MATERIAL_MEASURES, EQUIPMENT: EQUIPMENT_MEASURES, LABOUR: LABOUR_MEASURES}

# the measure shown by default for each type
HEADLINE_MEASURE = {MATERIAL: "preco_unitario", EQUIPMENT: "custo_produtivo", LABOUR: "custo"}

# totals must be above zero, components may be zero
TOTAL_MEASURES = ["preco_unitario", "custo_produtivo", "custo_improdutivo", "custo"]

# components listed in the per-item breakdowns
EQUIPMENT_COMPONENTS = EQUIPMENT_MEASURES[:7]
LABOUR_COMPONENTS = ["salario", "encargos_totais", "periculosidade_insalubridade"]

LAYOUT_OLD = "pre_2025"
LAYOUT_NEW = "2025_plus"

# ---- fixed values: sheet layouts, tried in this order -------------------------
# report type -> list of (header cells, column names)

SHEET_LAYOUTS = {
    MATERIAL: [
        (
            ["Código", "Descrição", "Unidade", "Preço Unitário (R$)"],
            ["codigo", "descricao", "unidade", "preco_unitario"],
        ),
    ],
    EQUIPMENT: [
        (
            [
                "Código", "Descrição", "Valor de Aquisição (R$)", "Depreciação (R$/h)",
                "Oportunidade de Capital (R$/h)", "Seguros e Impostos (R$/h)", "Manutenção (R$/h)",
                "Operação (R$/h)", "Mão de Obra de Operação (R$/h)", "Custo Produtivo (R$/h)",
                "Custo Improdutivo (R$/h)",
            ],
            ["codigo", "descricao"] + EQUIPMENT_MEASURES,
        ),
    ],
    LABOUR: [
        (
            [
                "Código", "Descrição", "Unidade", "Salário (R$)", "Encargos Totais", "Custo (R$)",
                "Periculosidade/ Insalubridade",
            ],
            ["codigo", "descricao", "unidade"] + LABOUR_MEASURES,
        ),
        (
            ["Código", "Descrição", "Unidade", "Custo (R$)"],
            ["codigo", "descricao", "unidade", "custo"],
        ),
    ],
}
TEXT_COLUMNS = ["codigo", "descricao", "unidade"]
EMPTY_NUMBER = "-"

# ---- fixed values: how report files and links are recognised -------------------

REPORT_EXTENSION = ".xlsx"
REPORT_NAME_ANCHORS = ["relat", "sint"]
LABOUR_NAME_PATTERN = r"m.{0,2}o\s+de\s+obra"
REGIME_NAME_PATTERN = r"desonera.{0,2}o"
REVISED_WORD = "revisado"

IGNORED_LINK_SCHEMES = ["mailto:", "tel:", "javascript:"]
EXCLUDED_LINK_WORDS = ["notarevisional", "nota-revisional", "/search"]
MAX_LINK_DEPTH = 5

# white space as Python's str.split() sees it: Unicode White_Space and four separators
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
WHITESPACE_CHARACTERS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# ---- fixed values: display labels ------------------------------------------------

TYPE_LABELS = {MATERIAL: "Materiais", EQUIPMENT: "Equipamentos", LABOUR: "Mão de Obra"}
MEASURE_LABELS = {
    "preco_unitario": "Preço Unitário",
    "custo_produtivo": "Custo Produtivo",
    "custo_improdutivo": "Custo Improdutivo",
    "valor_aquisicao": "Valor de Aquisição",
    "depreciacao": "Depreciação",
    "oportunidade_capital": "Oportunidade de Capital",
    "seguros_impostos": "Seguros e Impostos",
    "manutencao": "Manutenção",
    "operacao": "Operação",
    "mao_de_obra_operacao": "Mão de Obra de Operação",
    "salario": "Salário",
    "encargos_totais": "Encargos Totais",
    "custo": "Custo",
    "periculosidade_insalubridade": "Periculosidade e Insalubridade",
}
REGION_LABELS = {
    "centro-oeste": "Centro-Oeste",
    "nordeste": "Nordeste",
    "norte": "Norte",
    "sudeste": "Sudeste",
    "sul": "Sul",
}
LAYOUT_LABELS = {LAYOUT_OLD: "Até 2025", LAYOUT_NEW: "2025 em diante"}
MONTH_LABELS = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
REGIME_LABELS = {True: "Desonerado", False: "Não Desonerado"}
YES, NO = "Sim", "Não"
ALL_STATES = "Todas as UFs"
MISSING_CHANGE = "—"
MISSING_DIFFERENCE = "-"
