"""Rule data of the pipeline: vocabularies, patterns and thresholds, as plain values.

Everything here is a fixed value that results depend on; the logic that uses it is
elsewhere. Regular expressions are Java's, with Unicode classes switched on where used.
"""

# Modality signals, evaluated top to bottom, the first hit wins.
MODALITY = (
    ("must_not", "不得|禁止|不应|不可|严禁"),
    ("must", "必须|应当|须要|须"),
    ("must", "应"),
    ("should", "宜|建议"),
    ("may", "可|允许"),
    ("define", "是指|定义为"),
    ("must_not", r"(?iU)shall\s+not|must\s+not|prohibited|is\s+not\s+(?:allowed|permitted)"),
    ("must", r"(?iU)shall|must|is\s+required\s+to"),
    ("should", r"(?iU)should|recommended"),
    ("may", r"(?iU)may|permitted|can"),
    ("define", r"(?iU)means|refers\s+to|is\s+defined\s+as"),
)

# Tag dictionaries, matched as substrings of lower-cased text.
TOPICS = {
    "seats": ("座椅", "座垫", "靠背", "头枕", "安全带"),
    "braking-system": ("制动", "刹车", "制动液", "制动盘", "abs"),
    "lighting-system": ("灯光", "前照灯", "尾灯", "转向灯", "倒车灯", "牌照灯", "示廓灯"),
    "vehicle-dimensions": ("长", "宽", "高", "尺寸", "轴距", "轮距", "外廓"),
    "school-bus": ("校车", "学生客车", "学童"),
}
ENTITIES = {
    "vehicle": ("机动车", "汽车", "车辆", "客车", "货车", "拖拉机", "摩托车"),
    "component": ("座椅", "制动", "灯光", "轮胎", "发动机", "方向盘", "安全带"),
    "passenger": ("乘员", "乘客", "驾驶员", "驾驶人", "儿童"),
}

# Standard families in order of precedence, on upper-cased text.
STANDARD_TYPES = (
    ("gb-t", r"(?U)GB\s*/\s*T"),
    ("gb-z", r"(?U)GB\s*/\s*Z"),
    ("gb", r"(?U)\bGB\b"),
    ("iso", r"(?U)\bISO\b"),
    ("iec", r"(?U)\bIEC\b"),
    ("sae", r"(?U)\bSAE\b"),
    ("unece", r"(?U)UNECE|UN\s*ECE|UN\s*R\s*\d"),
    ("ece", r"(?U)ECE\s*R\s*\d"),
)
STANDARD_IDS = (
    r"(?iU)(GB\s*/?\s*T?\s*\d+(?:\.\d+)?[-:]\d{4})",
    r"(?iU)(ISO\s*\d+(?::\d{4})?)",
    r"(?iU)(IEC\s*\d+(?:[-:]\d{4})?)",
    r"(?iU)(ECE\s*R\s*\d+(?:\s*Rev\.\d+)?)",
)
PATH_ID = r"(?i)([a-z]+[-/][0-9]+(?:[-/][0-9]{4})?)"

# Date labels and the five shapes they come in.
RELEASE = ("发布|发布日期|release(?:d)?|issued|公布", "发布|发布日期|release")
EFFECTIVE = ("实施|实施日期|effective(?: date)?|生效|施行", "实施|实施日期|effective|生效|施行")
_DASHED, _HAN = r"\d{4}[-/]\d{1,2}[-/]\d{1,2}", r"\d{4}年\d{1,2}月\d{1,2}日"


def date_shapes(labels: tuple[str, str]) -> tuple[str, ...]:
    """Patterns in order of precedence: label first, label after, compact, label later on the line, 年月日."""
    first, after = labels
    return (
        rf"(?U)(?:{first})\s*[:：]?\s*({_DASHED})",
        rf"(?U)({_DASHED})\s*(?:{after})",
        rf"(?U)(\d{{8}})\s*(?:{after})",
        rf"(?U)({_DASHED})[^\n]*?(?:{after})",
        rf"(?U)(?:{first})\s*[:：]?\s*({_HAN})",
    )


# Publishers in order of precedence.
PUBLISHER_LABEL = r"(?mdU)发布部门\s*[:：]\s*(.+)$"
PUBLISHER_BODIES = "(?:中华人民共和国)?(?:工信部|市场监管总局|国家标准化管理委员会|国家发展和改革委员会)"
PUBLISHER_ENGLISH = r"(?iU)(?:published by|issued by)\s*:?\s*([^\n]+)"
PUBLISHER_ACRONYM = r"(?U)\b(ISO|IEC|UNECE|SAC|SAE)\b"

# Provision labels at line starts: number, article, annex; one alternation of label and separator.
LABELS = (
    r"(?mdU)^(?:(\d+(?:\.\d+)*)(\s+|[.．、]\s*)|(第[一二三四五六七八九十百千零\d]+条)(\s*)|((?:附录|Annex|Appendix)\s*[A-Za-z\d]+)(\s*[.:：]\s*))"
)

# Artefacts of text extraction.
PICTURE = r"(?U)\*\*==>\s*picture.*?<==\*\*\n?"
BRACKETED = "\\[([一-鿿\\u3000-\\u303f\\uff00-\\uffef—‘’“”,./\\-、，。：；！？;:)+]+\\n?)\\]|(\\[[^\\]]+\\])"
STANDARD_TOKENS = (
    (r"(?iU)\bGB\s*/\s*T\s*", "GB/T "),
    (r"(?iU)\bGB\s+/\s+T\s*", "GB/T "),
    (r"(?iU)\bGB/T\s+(\d)", "GB/T $1"),
    (r"(?iU)\bGB\s*(\d{3,})\s*[—-]\s*(\d{4})", "GB $1—$2"),
    (r"(?iU)\bGB/T\s*(\d{3,})\s*[—-]\s*(\d{4})", "GB/T $1—$2"),
    (r"(?U)([—-])\s+(\d{4})(?=\D|$)", "$1$2"),
)
CJK_GAP = r"(?U)(?<=[一-鿿])\s+(?=[一-鿿])"
STANDARD_HEADER = r"(?iU)^#{0,6}\s*(?:GB\s*/?\s*T?|GB/T|ISO|IEC|ECE\s*R|UN\s*R)\s*[\dA-Z][\w./\s—\-:]*\d{4}\s*$"
PAGE_NUMBER = r"(?U)^\s*(?:\d{1,3}|[IVXLC]+|[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩⅪⅫ]+)\s*$"
ICS_LINE = r"(?U)^\s*ICS\b.*CCS\b.*$"
OMITTED = "intentionally omitted"

# Patterns of tables of contents.
TOC_LABEL = r"(?U)^目\s*录$|(?i)^Contents?$|^(?:第[一二三四五六七八九十百千零\d]+[篇章节])"
TOC_TEXT = r"(?mdU)^\s*[\d.]+\s+.+\s*\.{2,}\s*\d+\s*$|^\s*\.{3,}\s*$"

# Attachment suffixes, raw folders, check categories, job states, thresholds.
ATTACHMENTS = (".pdf", ".doc", ".docx")
RAW_FOLDERS = {"standard": "standards", "regulation": "regulations", "policy_notice": "policies", "rule": "rules", "interpretation": "interpretations", "web": "web"}
CHECK_CATEGORIES = {
    "document_id_exists": "missed_document",
    "provision_label_exists": "missed_provision",
    "keyword_search": "missed_provision",
    "requirement_modality_exists": "missed_requirement",
    "evidence_quote_exists": "citation_missing",
    "metadata_field_equals": "metadata_mismatch",
    "topic_tag_exists": "topic_mismatch",
    "sqlite_table_row_count": "export_sqlite",
    "sqlite_fts_result": "export_sqlite",
    "graph_node_exists": "export_graph",
    "graph_edge_exists": "export_graph",
    "graph_edge_integrity": "export_graph",
}
SEVERITIES = ("info", "warn", "error")
JOB_STATES = ("pending", "running", "completed", "failed")
SHORT_TEXT, WEAK_QUOTE, DENSE, EXAMPLES = 5, 3, 2.0, 5
TEXT_PAGE, FEW_TEXT_PAGES, POOR_AVERAGE, SPARSE = 50, 3, 50, 500
GAPS_PER_LINE, TITLE_CHARS, HEAVY_PAGES = 4, 5, 10
SNIPPET, SHORT_QUOTE, HIT_TEXT, FALLBACK_QUOTE = 200, 120, 200, 200
