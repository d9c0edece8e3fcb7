"""DuckDB SQL with the results of the core's queries, written on its own."""

from __future__ import annotations

KEYWORDS = ("制动", "shall", "座椅", "e")
_WS = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_WS}+', ''), '{_WS}+$', '')"


_LAST = "(SELECT * FROM documents WHERE document_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY ingested_at DESC NULLS LAST, doc_id DESC) = 1)"
_LABELS = (
    rf"(?m)^(?:([0-9]+(?:\.[0-9]+)*)({_WS}+|[.．、]{_WS}*)|(第[一二三四五六七八九十百千零0-9]+条)({_WS}*)"
    rf"|((?:附录|Annex|Appendix){_WS}*[A-Za-z0-9]+)({_WS}*[.:：]{_WS}*))"
)
_SPLIT = f"""
    marked AS (
        SELECT document_id, string_split(regexp_replace(text, '{_LABELS}', chr(1) || '\\1\\3\\5' || chr(2) || '\\2\\4\\6' || chr(3), 'g'), chr(1)) AS parts
        FROM {_LAST} WHERE text IS NOT NULL
    ), cut AS (
        SELECT document_id, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS pos, len(parts) AS n_parts FROM marked
    ), sized AS (
        SELECT *, length(replace(replace(part, chr(2), ''), chr(3), '')) AS n, {_strip("CASE WHEN contains(part, chr(3)) THEN split_part(part, chr(3), -1) ELSE part END")} AS body,
               CASE WHEN n_parts = 1 THEN 'fallback' ELSE split_part(part, chr(2), 1) END AS label
        FROM cut
    ), placed AS (
        SELECT *, CASE WHEN n_parts = 1 THEN 0 ELSE sum(n) OVER (PARTITION BY document_id ORDER BY pos) - n END AS source_offset FROM sized
    ), kept AS (
        SELECT document_id, label, body, source_offset::INT AS source_offset, n_parts = 1 AS fallback,
               document_id || '-' || lower(replace(replace({_strip("label")}, ' ', '-'), '.', '-')) AS base_id,
               {_strip("split_part(body, chr(10), 1)")} AS head,
               CASE WHEN contains(body, chr(10)) THEN {_strip("substr(body, instr(body, chr(10)) + 1)")} ELSE '' END AS rest
        FROM placed WHERE (pos > 0 AND body <> '') OR n_parts = 1
    ), counted AS (
        SELECT *, row_number() OVER (PARTITION BY document_id, label ORDER BY source_offset) AS occurrence,
               row_number() OVER (PARTITION BY document_id, base_id ORDER BY source_offset) AS nth FROM kept
    ), split AS (
        SELECT document_id, CASE WHEN nth > 1 THEN base_id || '-dup-' || nth ELSE base_id END AS provision_id, label,
               CASE WHEN fallback THEN 'unknown' WHEN regexp_matches(label, '^第.+条') THEN 'article'
                    WHEN regexp_matches(label, '(?i)^(附录|annex|appendix)') THEN 'annex' WHEN contains(label, '.') THEN 'clause' ELSE 'section' END AS kind,
               CASE WHEN NOT fallback AND rest <> '' THEN head ELSE 'unknown' END AS title,
               CASE WHEN fallback THEN body WHEN rest <> '' THEN rest WHEN contains(body, chr(10)) THEN head ELSE body END AS text,
               occurrence, source_offset, CASE WHEN nth > 1 OR fallback THEN 'low' ELSE 'medium' END AS confidence, fallback
        FROM counted
    )
"""


def _modality(x: str) -> str:
    w = f"{_WS}+"
    low = f"lower({x})"
    return f"""CASE
        WHEN regexp_matches({x}, '不得|禁止|不应|不可|严禁') THEN 'must_not' WHEN regexp_matches({x}, '必须|应当|须要|须|应') THEN 'must'
        WHEN regexp_matches({x}, '宜|建议') THEN 'should' WHEN regexp_matches({x}, '可|允许') THEN 'may' WHEN regexp_matches({x}, '是指|定义为') THEN 'define'
        WHEN regexp_matches({low}, 'shall{w}not|must{w}not|prohibited|is{w}not{w}(allowed|permitted)') THEN 'must_not'
        WHEN regexp_matches({low}, 'shall|must|is{w}required{w}to') THEN 'must' WHEN regexp_matches({low}, 'should|recommended') THEN 'should'
        WHEN regexp_matches({low}, 'may|permitted|can') THEN 'may' WHEN regexp_matches({low}, 'means|refers{w}to|is{w}defined{w}as') THEN 'define' ELSE 'unknown' END"""


_FOUND = f"""{_SPLIT}, found AS (
        SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY source_offset, provision_id) AS nth,
               CASE WHEN fallback THEN {_strip("left(text, 200)")} ELSE left(text, 200) END AS quote
        FROM (SELECT *, {_modality("text")} AS modality FROM split) WHERE modality <> 'unknown'
    )"""


def _type(x: str) -> str:
    u = f"upper(coalesce({x}, ''))"
    edge = r"(?:^|[^\pL\pN_\pM])"
    word = lambda w: f"regexp_matches({u}, '{edge}{w}(?:$|[^\\pL\\pN_\\pM])')"
    return f"""CASE WHEN regexp_matches({u}, 'GB{_WS}*/{_WS}*T') THEN 'gb-t' WHEN regexp_matches({u}, 'GB{_WS}*/{_WS}*Z') THEN 'gb-z' WHEN {word("GB")} THEN 'gb'
        WHEN {word("ISO")} THEN 'iso' WHEN {word("IEC")} THEN 'iec' WHEN {word("SAE")} THEN 'sae'
        WHEN regexp_matches({u}, 'UNECE|UN{_WS}*ECE|UN{_WS}*R{_WS}*[0-9]') THEN 'unece' WHEN regexp_matches({u}, 'ECE{_WS}*R{_WS}*[0-9]') THEN 'ece' ELSE 'unknown' END"""


_REFS = """
    refs AS (
        SELECT 'requirements.provision_id' AS field_name, requirement_id AS rec_id, provision_id AS ref_key, ingested_at FROM requirements
        UNION ALL SELECT 'provisions.document_id', provision_id, document_id, ingested_at FROM provisions
        UNION ALL SELECT 'requirements.document_id', requirement_id, document_id, ingested_at FROM requirements
    ), recs AS (
        SELECT DISTINCT field_name, rec_id, ref_key, min(ingested_at) OVER (PARTITION BY field_name, rec_id) AS first_in
        FROM refs WHERE rec_id IS NOT NULL
    ), parents AS (
        SELECT 'provisions' AS parent, provision_id AS ref_key, min(ingested_at) AS parent_first, max(deleted_at IS NOT NULL) AS gone FROM provisions GROUP BY provision_id
        UNION ALL SELECT 'documents', document_id, min(ingested_at), max(deleted_at IS NOT NULL) FROM documents GROUP BY document_id
    ), judged AS (
        SELECT r.field_name, r.rec_id, strftime(r.first_in, '%Y-%m') AS period,
               CASE WHEN p.ref_key IS NULL THEN 'missing' WHEN p.gone THEN 'deleted' WHEN p.parent_first > r.first_in THEN 'late' END AS reason
        FROM recs r LEFT JOIN parents p
          ON p.ref_key = r.ref_key AND p.parent = CASE WHEN r.field_name = 'requirements.provision_id' THEN 'provisions' ELSE 'documents' END
        WHERE r.ref_key IS NOT NULL
    )
"""
_MERGED = "(SELECT id, coalesce(list_sort(list_distinct(flatten(list(coalesce(topics, []))))), []) AS topics, coalesce(list_sort(list_distinct(flatten(list(coalesce(entities, []))))), []) AS entities FROM tags WHERE id IS NOT NULL GROUP BY id)"
_LINES = "(SELECT doc_id, unnest(string_split(source_text, chr(10))) AS line, generate_subscripts(string_split(source_text, chr(10)), 1) - 1 AS pos FROM documents WHERE source_text IS NOT NULL)"
_TITLED = """(SELECT doc_id, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) - 1 AS pos
    FROM (SELECT doc_id, source_text || chr(10) || title || chr(10) || 'of' || chr(10) || '| ' || title || ' |' || chr(10) || '|---|' AS body FROM documents) WHERE body IS NOT NULL)"""
_TOPICS = {
    "seats": "座椅 座垫 靠背 头枕 安全带", "braking-system": "制动 刹车 制动液 制动盘 abs", "lighting-system": "灯光 前照灯 尾灯 转向灯 倒车灯 牌照灯 示廓灯",
    "vehicle-dimensions": "长 宽 高 尺寸 轴距 轮距 外廓", "school-bus": "校车 学生客车 学童",
}
_ENTITIES = {"vehicle": "机动车 汽车 车辆 客车 货车 拖拉机 摩托车", "component": "座椅 制动 灯光 轮胎 发动机 方向盘 安全带", "passenger": "乘员 乘客 驾驶员 驾驶人 儿童"}
_BODY = "lower(concat_ws(' ', nullif(text, ''), nullif(title, ''), nullif(source_text, ''), nullif(evidence.quote, '')))"


def _tags(groups: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN regexp_matches(body, '{words.replace(' ', '|')}') THEN '{tag}' END" for tag, words in sorted(groups.items()))
    return f"array_to_string(list_filter([{cases}], lambda x: x IS NOT NULL), ',')"


_NODES = """
    nodes AS (
        SELECT document_id AS id, 'Document' AS type, max(title) AS name FROM documents WHERE document_id IS NOT NULL GROUP BY document_id
        UNION ALL SELECT DISTINCT replaces, 'Document', NULL FROM documents WHERE replaces IS NOT NULL AND replaces NOT IN (SELECT document_id FROM documents WHERE document_id IS NOT NULL)
        UNION ALL SELECT provision_id, 'Provision', max(label) FROM provisions WHERE provision_id IS NOT NULL GROUP BY provision_id
        UNION ALL SELECT requirement_id, 'Requirement', max(modality) FROM requirements WHERE requirement_id IS NOT NULL GROUP BY requirement_id
        UNION ALL SELECT DISTINCT 'topic:' || t, 'Topic', t FROM (SELECT unnest(topics) AS t FROM tags) WHERE t IS NOT NULL
        UNION ALL SELECT DISTINCT 'entity:' || t, 'Entity', t FROM (SELECT unnest(entities) AS t FROM tags) WHERE t IS NOT NULL
    )
"""
_SUBSECTIONS = """
    rows AS (SELECT provision_id, max(document_id) AS document_id, max(label) AS label, max(locator.source_offset) AS pos_at FROM provisions WHERE provision_id IS NOT NULL AND document_id IS NOT NULL GROUP BY provision_id),
    last_of AS (SELECT document_id, label AS parent_label, pos_at, provision_id AS parent FROM rows QUALIFY row_number() OVER (PARTITION BY document_id, label ORDER BY pos_at DESC NULLS LAST, provision_id DESC) = 1),
    sub AS (
        SELECT c.provision_id AS source, p.parent AS target, 'SUBSECTION_OF' AS type FROM rows c JOIN last_of p
          ON p.document_id = c.document_id AND p.parent_label = regexp_replace(c.label, '\\.[^.]*$', '') AND contains(c.label, '.') AND p.pos_at < c.pos_at
    )
"""
_EDGES = f"""{_SUBSECTIONS}, edges AS (
        SELECT document_id AS source, provision_id AS target, 'HAS_PROVISION' AS type FROM provisions WHERE document_id IS NOT NULL AND provision_id IS NOT NULL
        UNION SELECT provision_id, requirement_id, 'HAS_REQUIREMENT' FROM requirements WHERE provision_id IS NOT NULL AND requirement_id IS NOT NULL
        UNION SELECT document_id, replaces, 'REPLACES' FROM documents WHERE document_id IS NOT NULL AND replaces IS NOT NULL
        UNION SELECT replaces, document_id, 'REPLACED_BY' FROM documents WHERE document_id IS NOT NULL AND replaces IS NOT NULL
        UNION SELECT id, 'topic:' || t, 'ABOUT' FROM (SELECT id, unnest(topics) AS t FROM tags) WHERE id IS NOT NULL AND t IS NOT NULL
        UNION SELECT id, 'entity:' || t, 'MENTIONS' FROM (SELECT id, unnest(entities) AS t FROM tags) WHERE id IS NOT NULL AND t IS NOT NULL
        UNION SELECT * FROM sub
    )
"""
_FINDINGS_D = """
    SELECT document_id AS id, level, message FROM documents, (VALUES ('error', 'missing document_id'), ('error', 'missing title'), ('error', 'missing review_status'), ('warning', 'missing source_text'), ('warning', 'missing raw_path')) r(level, message)
    WHERE CASE message WHEN 'missing document_id' THEN coalesce(document_id, '') IN ('', 'unknown') WHEN 'missing title' THEN coalesce(title, '') IN ('', 'unknown')
          WHEN 'missing review_status' THEN coalesce(review_status, '') IN ('', 'unknown') WHEN 'missing source_text' THEN source_text IS NULL ELSE raw_path IS NULL END"""
_FINDINGS_P = f"""
    SELECT provision_id AS id, level, message FROM (SELECT *, row_number() OVER (PARTITION BY provision_id ORDER BY ingested_at) AS nth FROM provisions),
        (VALUES ('error', 'missing provision_id'), ('error', 'duplicate provision_id'), ('warning', 'missing locator'), ('error', 'missing quote')) r(level, message)
    WHERE CASE message WHEN 'missing provision_id' THEN coalesce(provision_id, '') IN ('', 'unknown') WHEN 'duplicate provision_id' THEN provision_id IS NOT NULL AND nth > 1
          WHEN 'missing locator' THEN locator IS NULL ELSE {_strip("coalesce(evidence.quote, '')")} = '' END"""
_FINDINGS_R = f"""
    SELECT requirement_id AS id, level, message FROM requirements, (VALUES ('error', 'missing requirement_id'), ('error', 'missing modality'), ('error', 'missing document_id'), ('error', 'missing provision_id'), ('error', 'missing quote')) r(level, message)
    WHERE CASE message WHEN 'missing requirement_id' THEN coalesce(requirement_id, '') IN ('', 'unknown') WHEN 'missing modality' THEN coalesce(modality, '') IN ('', 'unknown')
          WHEN 'missing document_id' THEN coalesce(document_id, '') IN ('', 'unknown') WHEN 'missing provision_id' THEN coalesce(provision_id, '') IN ('', 'unknown') ELSE {_strip("coalesce(evidence_quote, '')")} = '' END"""
_SHORT = f"SELECT document_id, provision_id, length({_strip("coalesce(text, '')")}) AS n_chars FROM provisions WHERE length({_strip("coalesce(text, '')")}) < 5"
_DUPLICATES = """
    SELECT document_id, label, count(*) AS n, array_to_string(list_sort(list(provision_id) FILTER (nth <= 5)), ',') AS examples
    FROM (SELECT *, row_number() OVER (PARTITION BY document_id, label ORDER BY provision_id) AS nth FROM provisions WHERE coalesce(label, '') <> '' AND label <> 'fallback' AND document_id IS NOT NULL)
    GROUP BY document_id, label HAVING count(*) > 1"""
_TOC = rf"""
    SELECT document_id, provision_id, CASE WHEN regexp_matches(coalesce(label, ''), '^目{_WS}*录$|^(?i:Contents?)$|^第[一二三四五六七八九十百千零0-9]+[篇章节]') THEN 'label'
        WHEN regexp_matches(coalesce(text, ''), '(?m)^{_WS}*[\p{{Nd}}.]+{_WS}+.+{_WS}*\.{{2,}}{_WS}*\p{{Nd}}+{_WS}*$|^{_WS}*\.{{3,}}{_WS}*$') THEN 'text' END AS reason
    FROM provisions"""
_WEAK = f"""
    SELECT document_id, requirement_id, CASE WHEN length({_strip("coalesce(evidence_quote, '')")}) = 0 THEN 'missing' ELSE 'short' END AS reason
    FROM requirements WHERE length({_strip("coalesce(evidence_quote, '')")}) < 3"""
_FALLBACK = "SELECT document_id, bool_or(coalesce(label = 'fallback', FALSE)) AND NOT bool_or(coalesce(label <> 'fallback', TRUE)) AS fallback_only FROM provisions WHERE document_id IS NOT NULL GROUP BY document_id"


def _hits(table: str, key: str, body: str, cond: str) -> str:
    return f"SELECT DISTINCT {key} AS id, CASE WHEN length(coalesce({body}, '')) > 200 THEN left({body}, 200) || '…' ELSE coalesce({body}, '') END AS snippet FROM {table} WHERE {key} IS NOT NULL AND ({cond})"


def _in(term: str, *cols: str) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({c}, '')), '{term}')" for c in cols) + ")"


_P, _D, _R = ("label", "title", "text"), ("title", "raw_path"), ("modality", "subject", "action", "object", "evidence_quote")
_LATEST_JOB = "(SELECT * FROM jobs WHERE job_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY coalesce(updated_at, created_at) DESC NULLS LAST, status DESC, error DESC NULLS LAST, input DESC NULLS LAST) = 1)"
_MANIFEST = """(SELECT provision_id, max(label) AS label, max(title) AS title, max(concat_ws('@', locator.label, locator.source_offset::VARCHAR)) AS locator, max(confidence) AS confidence,
        max(CASE WHEN length(coalesce(evidence.quote, '')) > 120 THEN left(evidence.quote, 120) || '...' ELSE coalesce(evidence.quote, '') END) AS short_quote
    FROM provisions WHERE provision_id IS NOT NULL GROUP BY provision_id)"""
_REVIEWED = "(SELECT DISTINCT provision_id FROM requirements WHERE review_status = 'reviewed' AND provision_id IS NOT NULL)"
_CHECKS = """
    d AS (SELECT DISTINCT document_id FROM documents WHERE document_id IS NOT NULL),
    results AS (
        SELECT 'document_id_exists:' || document_id AS id, 'document_id_exists' AS type, 'missed_document' AS category, TRUE AS passed FROM d
        UNION ALL SELECT 'provision_label_exists:' || document_id, 'provision_label_exists', 'missed_provision', document_id IN (SELECT document_id FROM provisions WHERE label = '2.1' AND document_id IS NOT NULL) FROM d
        UNION ALL SELECT 'requirement_modality_exists:' || document_id, 'requirement_modality_exists', 'missed_requirement', document_id IN (SELECT document_id FROM requirements WHERE modality = 'must' AND document_id IS NOT NULL) FROM d
        UNION ALL SELECT 'topic_tag_exists:' || document_id, 'topic_tag_exists', 'topic_mismatch', document_id IN (SELECT document_id FROM tags WHERE list_contains(topics, 'seats') AND document_id IS NOT NULL) FROM d
        UNION ALL SELECT 'evidence_quote_exists:' || document_id, 'evidence_quote_exists', 'citation_missing', document_id IN (
            SELECT document_id FROM provisions WHERE document_id IS NOT NULL AND (contains(coalesce(text, ''), 'shall') OR contains(coalesce(title, ''), 'shall') OR contains(coalesce(evidence.quote, ''), 'shall'))) FROM d
        UNION ALL SELECT 'metadata_field_equals:' || document_id, 'metadata_field_equals', 'metadata_mismatch', document_id IN (SELECT document_id FROM documents GROUP BY document_id HAVING min(review_status) = 'draft') FROM d
        UNION ALL SELECT 'no_such_type:' || document_id, 'no_such_type', 'missed_document', FALSE FROM d
    )
"""


def _date(x: str, first: str, after: str) -> str:
    day, han = "[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}", "[0-9]{4}年[0-9]{1,2}月[0-9]{1,2}日"
    shapes = (f"({first}){_WS}*[:：]?{_WS}*({day})", f"({day}){_WS}*({after})", f"([0-9]{{8}}){_WS}*({after})", f"({day})[^\\n]*?({after})", f"({first}){_WS}*[:：]?{_WS}*({han})")
    raw = ", ".join(f"nullif(regexp_extract({x}, '{p.replace(f'({first})', f'(?:{first})')}', 1), '')" for p in shapes)
    digits = f"regexp_extract_all(coalesce({raw}), '[0-9]+')"
    return f"""(SELECT CASE WHEN len(d) = 3 THEN d[1] || '-' || lpad(d[2], 2, '0') || '-' || lpad(d[3], 2, '0') WHEN len(d) = 1 THEN left(d[1], 4) || '-' || substr(d[1], 5, 2) || '-' || substr(d[1], 7, 2) END FROM (SELECT {digits} AS d))"""


_HAN = "left({d}, 4) || '年' || substr({d}, 6, 2) || '月' || substr({d}, 9, 2) || '日'"


def statements() -> dict[str, str]:
    """DuckDB SQL by query name."""
    merged = f"SELECT id, array_to_string(topics, ',') AS topics, array_to_string(entities, ',') AS entities FROM {_MERGED}"
    dated = f"""CASE doc_id % 5 WHEN 0 THEN '发布日期：' || release_date || chr(10) || '实施 ' || replace(effective_date, '-', '/')
        WHEN 1 THEN release_date || ' 发布' || chr(10) || effective_date || ' 实施' WHEN 2 THEN replace(release_date, '-', '') || '发布' || chr(10) || replace(effective_date, '-', '') || ' effective'
        WHEN 3 THEN release_date || ' (first) release' || chr(10) || effective_date || ' is effective' ELSE '公布：' || {_HAN.format(d="release_date")} || chr(10) || '施行 ' || {_HAN.format(d="effective_date")} END"""
    out = {
        "p5_found": f"WITH {_REFS} SELECT DISTINCT field_name, rec_id, reason, period FROM judged WHERE reason IS NOT NULL",
        "p5_report": f"""WITH {_REFS}
            SELECT field_name, period, count(*) AS n_references, count(*) FILTER (reason = 'missing') AS n_missing,
                   count(*) FILTER (reason = 'deleted') AS n_deleted, count(*) FILTER (reason = 'late') AS n_late
            FROM judged GROUP BY field_name, period""",
        "tag_union_merge": merged,
        "tag_last_wins": "SELECT id, max(struct_pack(t := topics, e := entities)).t AS topics, max(struct_pack(t := topics, e := entities)).e AS entities FROM (SELECT id, coalesce(array_to_string(topics, ','), '') AS topics, coalesce(array_to_string(entities, ','), '') AS entities FROM tags WHERE id IS NOT NULL) GROUP BY id",
        "slugify": f"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace({_strip('lower(title)')}, '[^\\pL\\pM\\pN_\\x{{200c}}\\x{{200d}}-]+', '-', 'g'), '-+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM documents",
        "clean_artifacts": f"""SELECT doc_id, md5(c) AS md5, length(c) AS n FROM (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(source_text, '\\*\\*==>{_WS}*picture.*?<==\\*\\*\\n?', '', 'g'), '([a-z])([A-Z])', '\\1 \\2', 'g'), '<br{_WS}*/?>', '', 'g') AS c FROM documents)""",
        "unwrap_brackets": r"SELECT provision_id, md5(c) AS md5, length(c) AS n FROM (SELECT provision_id, regexp_replace(text, '\[([一-鿿\x{3000}-\x{303f}\x{ff00}-\x{ffef}—‘’“”,./\-、，。：；！？;:)+]+\n?)\]|(\[[^\]]+\])', '\1\2', 'g') AS c FROM provisions)",
        "blank_lines": f"SELECT doc_id, md5(c) AS md5, length(c) AS n FROM (SELECT doc_id, {_strip("regexp_replace(source_text, '\\n{3,}', chr(10) || chr(10), 'g')")} AS c FROM documents)",
        "table_title_dedup": f"""
            WITH l AS (SELECT *, regexp_replace(line, '[\\s\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}|]+', '', 'g') AS own, NOT contains(line, '|') AND {_strip("line")} <> '' AS plain FROM {_TITLED}),
            k AS (SELECT *, list(own) FILTER (plain) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS kept FROM l)
            SELECT doc_id, pos::INT AS pos, line FROM k WHERE contains(line, '|') AND NOT regexp_matches(line, '^[\\s|:-]*$') AND length(own) > 5
              AND len(list_filter(coalesce(kept, [])[-3:], lambda t: contains(t, own) OR contains(own, t))) > 0""",
        "page_noise": f"""
            WITH l AS (SELECT *, CASE WHEN regexp_matches(line, '(?i)^#{{0,6}}{_WS}*(GB{_WS}*/?{_WS}*T?|GB/T|ISO|IEC|ECE{_WS}*R|UN{_WS}*R){_WS}*[\\pNdA-Z][\\pL\\pM\\pN_./\\s\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}—:-]*[0-9]{{4}}{_WS}*$')
                THEN upper(regexp_replace(line, '{_WS}+', '', 'g')) END AS norm FROM {_LINES}),
            n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, norm ORDER BY pos) AS nth FROM l)
            SELECT doc_id, pos::INT AS pos, line FROM n WHERE {_strip("line")} = 'SAC' OR regexp_matches(line, '^{_WS}*ICS\\b.*CCS\\b.*$')
              OR regexp_matches(line, '^{_WS}*([0-9]{{1,3}}|[IVXLC]+|[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩⅪⅫ]+){_WS}*$') OR (norm IS NOT NULL AND nth > 1)""",
        "quality_assess": f"""
            SELECT doc_id, n AS total_chars, len(list_filter(string_split(source_text, chr(10)), lambda x: {_strip("x")} <> '')) AS n_lines, omitted::INT AS omitted_images,
                   len(regexp_extract_all(source_text, '[A-Za-z]{{50,}}')) AS long_runs, n / 2 AS avg_chars_per_page,
                   n / 2 < 50 OR omitted > 0.5 * 2 OR len(regexp_extract_all(source_text, '[A-Za-z]{{50,}}')) > 10 AS is_poor
            FROM (SELECT *, length(source_text) AS n, (length(source_text) - length(replace(source_text, 'intentionally omitted', ''))) // 21 AS omitted FROM documents WHERE source_text IS NOT NULL)""",
        "ocr_required": f"""SELECT document_id, count(*) FILTER (length({_strip("coalesce(text, '')")}) > 50) AS n_text_pages, count(*) FILTER (length({_strip("coalesce(text, '')")}) > 50) < 3 AS ocr_required FROM provisions WHERE document_id IS NOT NULL GROUP BY document_id""",
        "engine_selection": """SELECT p.document_id, pages, CASE WHEN NOT coalesce(ocr, FALSE) AND pages >= 10 THEN 'layout' WHEN chars < 500 THEN 'fallback' ELSE 'plain' END AS engine
            FROM (SELECT document_id, count(*) AS pages, sum(length(text)) AS chars FROM provisions WHERE document_id IS NOT NULL GROUP BY document_id) p
            LEFT JOIN (SELECT document_id, bool_or(ocr_required) AS ocr FROM documents GROUP BY document_id) d ON d.document_id = p.document_id""",
        "html_title": f"""SELECT doc_id, coalesce(nullif({_strip("replace(replace(replace(replace(replace(replace(replace(replace(regexp_extract(source_text, '(?is)<title[^>]*>(.*?)</title>', 1), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&ge;', '≥'), '&le;', '≤'), '&amp;', '&')")}, ''), document_id) AS title FROM documents WHERE source_text IS NOT NULL""",
        "attachments": """
            WITH l AS (SELECT doc_id, raw_path, coalesce(source_url, 'https://files.example.org/x/y') AS url FROM documents WHERE raw_path IS NOT NULL),
            a AS (SELECT doc_id, regexp_extract(url, '^[a-zA-Z]+://[^/]+') || '/b/C.DOCX' AS one, CASE WHEN regexp_matches(lower(raw_path), '\\.(pdf|doc|docx)$') THEN regexp_replace(url, '[^/]*$', '') || raw_path END AS two FROM l)
            SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter([one, two], lambda x: x IS NOT NULL))), ' ') AS links FROM a""",
        "snippets": r"SELECT provision_id, CASE WHEN length(text) > 200 THEN left(text, 200) || '…' ELSE text END AS snippet, regexp_replace(left(text, 40), '([\\%_])', '\\\1', 'g') AS like_escaped, regexp_matches(text, '[一-鿿]') AS has_cjk FROM provisions",
        "classify": f"SELECT doc_id, {_type('text')} AS by_text, {_type('standard_id')} AS by_id, {_type('raw_path')} AS by_path, CASE document_type WHEN 'standard' THEN 'standards' WHEN 'regulation' THEN 'regulations' WHEN 'policy_notice' THEN 'policies' WHEN 'rule' THEN 'rules' WHEN 'interpretation' THEN 'interpretations' ELSE 'web' END AS folder FROM documents",
        "standard_id": f"""SELECT doc_id, upper(replace(coalesce(nullif(regexp_extract(text, '(?i)(GB{_WS}*/?{_WS}*T?{_WS}*[0-9]+(?:\\.[0-9]+)?[-:][0-9]{{4}})', 1), ''), nullif(regexp_extract(text, '(?i)(ISO{_WS}*[0-9]+(?::[0-9]{{4}})?)', 1), ''),
                nullif(regexp_extract(text, '(?i)(IEC{_WS}*[0-9]+(?:[-:][0-9]{{4}})?)', 1), ''), nullif(regexp_extract(text, '(?i)(ECE{_WS}*R{_WS}*[0-9]+(?:{_WS}*Rev\\.[0-9]+)?)', 1), '')), ' ', '')) AS from_text,
                upper(nullif(regexp_extract(regexp_replace(regexp_extract(raw_path, '([^/]*)$', 1), '\\.[^.]*$', ''), '(?i)([a-z]+[-/][0-9]+(?:[-/][0-9]{{4}})?)', 1), '')) AS from_path FROM documents""",
        "dates": f"""
            WITH b AS (SELECT doc_id, {dated} AS body FROM documents)
            SELECT doc_id, {_date("body", "发布|发布日期|release(?:d)?|issued|公布", "发布|发布日期|release")} AS release,
                   {_date("body", "实施|实施日期|effective(?: date)?|生效|施行", "实施|实施日期|effective|生效|施行")} AS effective FROM b""",
        "publisher": f"""
            WITH n AS (SELECT doc_id, coalesce(text, '') || CASE doc_id % 3 WHEN 0 THEN coalesce(chr(10) || '发布部门： ' || publisher, '') WHEN 1 THEN coalesce(chr(10) || 'Issued by: ' || publisher, '') ELSE '' END AS body,
                       doc_id % 3 < 2 AND publisher IS NULL AS absent FROM documents)
            SELECT doc_id, CASE WHEN NOT absent THEN coalesce(nullif({_strip(f"regexp_extract(body, '(?m)发布部门{_WS}*[:：]{_WS}*(.+)$', 1)")}, ''),
                nullif(regexp_extract(body, '(?:中华人民共和国)?(?:工信部|市场监管总局|国家标准化管理委员会|国家发展和改革委员会)'), ''),
                nullif({_strip(f"regexp_extract(body, '(?i)(?:published by|issued by){_WS}*:?{_WS}*([^\\n]+)', 1)")}, ''),
                nullif(regexp_extract(body, '(?:^|[^\\pL\\pN_\\pM])(ISO|IEC|UNECE|SAC|SAE)(?:$|[^\\pL\\pN_\\pM])', 1), '')) END AS found FROM n""",
        "publisher_directory": "SELECT d.publisher, p.jurisdiction, count(*) AS n FROM documents d LEFT JOIN publishers p ON p.publisher = d.publisher GROUP BY ALL",
        "split_provisions": f"WITH {_SPLIT} SELECT document_id, provision_id, label, kind, title, occurrence, source_offset, confidence, md5(text) AS md5 FROM split",
        "provision_kind_counts": f"WITH {_SPLIT} SELECT kind, count(*) AS n FROM split GROUP BY kind",
        "requirements_extracted": f"WITH {_FOUND} SELECT provision_id || '-r' || nth AS requirement_id, document_id, provision_id, modality, confidence, md5(coalesce(nullif(quote, ''), left(text, 200))) AS md5 FROM found",
        "modality_distribution": f"WITH {_FOUND} SELECT document_id, modality, count(*) AS n FROM found GROUP BY ALL",
        "modality_of_provisions": f"SELECT {_modality('text')} AS modality, count(*) AS n FROM provisions GROUP BY 1",
        "tag_topics": f"SELECT provision_id, {_tags(_TOPICS)} AS topics, {_tags(_ENTITIES)} AS entities FROM (SELECT provision_id, {_BODY} AS body FROM provisions)",
        "matched_keywords": f"SELECT topic, keyword, count(*) AS n FROM (SELECT {_BODY} AS body FROM provisions) JOIN (VALUES {', '.join(f"('{t}', '{k}')" for t, w in _TOPICS.items() for k in w.split())}) k(topic, keyword) ON contains(body, keyword) GROUP BY ALL",
        "tag_junction": "SELECT DISTINCT id, topic FROM (SELECT id, unnest(topics) AS topic FROM tags) WHERE topic IS NOT NULL AND id IS NOT NULL",
        "provision_tags": f"SELECT p.provision_id, coalesce(array_to_string(topics, ','), '') AS topics, coalesce(len(entities), 0) AS n_entities FROM (SELECT DISTINCT provision_id FROM provisions) p LEFT JOIN {_MERGED} t ON t.id = p.provision_id",
        "requirement_tags": f"SELECT r.requirement_id, r.provision_id, coalesce(array_to_string(coalesce(o.topics, v.topics), ','), '') AS topics FROM (SELECT DISTINCT requirement_id, provision_id FROM requirements) r LEFT JOIN {_MERGED} o ON o.id = r.requirement_id LEFT JOIN {_MERGED} v ON v.id = r.provision_id",
        "draft_merge": """SELECT coalesce(m.document_id, d.document_id) AS document_id, coalesce(m.title, d.title) AS title, m.review_status, d.draft_path, m.document_id IS NULL AS draft_only
            FROM (SELECT document_id, max(title) AS title, max(review_status) AS review_status FROM documents WHERE document_id IS NOT NULL GROUP BY document_id) m
            FULL JOIN (SELECT document_id, max(title) AS title, 'drafts/' || document_id || '.md' AS draft_path FROM provisions WHERE document_id IS NOT NULL GROUP BY document_id) d ON d.document_id = m.document_id""",
        "duplicate_ids": """SELECT 'document' AS record_kind, document_id AS id, count(*) AS copies, count(*) AS nth FROM documents WHERE document_id IS NOT NULL GROUP BY document_id HAVING count(*) > 1
            UNION ALL SELECT 'provision', id, copies, unnest(range(2, copies + 1)) FROM (SELECT provision_id AS id, count(*) AS copies FROM provisions WHERE provision_id IS NOT NULL GROUP BY provision_id HAVING count(*) > 1)
            UNION ALL SELECT 'requirement', id, copies, unnest(range(2, copies + 1)) FROM (SELECT requirement_id AS id, count(*) AS copies FROM requirements WHERE requirement_id IS NOT NULL GROUP BY requirement_id HAVING count(*) > 1)""",
        "effective_dates_index": f"SELECT *, '| ' || document_id || ' | ' || title || ' | ' || release_date || ' | ' || effective_date || ' |' AS line FROM (SELECT document_id, coalesce(title, 'unknown') AS title, coalesce(nullif(release_date, ''), '—') AS release_date, coalesce(nullif(effective_date, ''), '—') AS effective_date FROM {_LAST})",
        "exported_documents": f"""SELECT document_id, title, publisher, md5(to_json(r)::VARCHAR) AS md5 FROM (SELECT document_id, coalesce(title, '') AS title, coalesce(publisher, '') AS publisher, struct_pack({', '.join(f"{c} := coalesce({c}, '')" for c in
            ("document_id", "title", "document_type", "standard_id", "publisher", "release_date", "effective_date", "source_url", "raw_path", "confidence", "review_status"))}) AS r FROM {_LAST})""",
        "tagged_records": f"""SELECT 'provision' AS record_type, coalesce(nullif(provision_id, ''), '') AS id, {_tags(_TOPICS)} AS topics, {_tags(_ENTITIES)} AS entities FROM (SELECT provision_id, {_BODY} AS body FROM provisions)
            UNION ALL SELECT 'requirement', coalesce(nullif(provision_id, ''), requirement_id, ''), {_tags(_TOPICS)}, {_tags(_ENTITIES)} FROM (SELECT provision_id, requirement_id, lower(coalesce(evidence_quote, '')) AS body FROM requirements)""",
        "manifest_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("documents", "provisions", "requirements", "tags", "jobs")),
        "duplicate_fingerprint": "SELECT sha256(text) AS sha256, count(*) AS n_rows, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
        "provision_pages": """
            SELECT p.provision_id, md5('---' || chr(10) || 'provision_id: ' || p.provision_id || chr(10) || 'review_status: ' || coalesce(review_status, 'draft') || chr(10) || '---' || chr(10) || chr(10) || '# ' || coalesce(label, '') || chr(10) || chr(10) || coalesce(text, '') || chr(10) || chr(10) || coalesce(items, '')) AS md5
            FROM (SELECT provision_id, max(review_status) AS review_status, max(label) AS label, max(text) AS text FROM provisions WHERE provision_id IS NOT NULL GROUP BY provision_id) p
            LEFT JOIN (SELECT provision_id, string_agg('- ' || requirement_id || ': ' || modality, chr(10) ORDER BY requirement_id) AS items FROM (SELECT requirement_id, max(provision_id) AS provision_id, max(modality) AS modality FROM requirements GROUP BY requirement_id) GROUP BY provision_id) r ON r.provision_id = p.provision_id""",
        "timeline": f"SELECT left(day, 7) AS month, event, count(*) AS n FROM (SELECT 'release' AS event, release_date AS day FROM {_LAST} UNION ALL SELECT 'effective', effective_date FROM {_LAST}) WHERE day IS NOT NULL GROUP BY ALL",
        "audit_short": f"SELECT document_id, provision_id, length({_strip("coalesce(label, '')")}) AS n_chars FROM provisions WHERE length({_strip("coalesce(label, '')")}) < 5",
        "audit_fallback": _FALLBACK,
        "audit_duplicates": _DUPLICATES,
        "audit_toc": f"SELECT * FROM ({_TOC.replace('FROM provisions', "FROM (SELECT * REPLACE (label || '  Scope  ..... ' || locator.source_offset AS text) FROM provisions)")}) WHERE reason IS NOT NULL",
        "audit_density": "SELECT p.document_id, n_provisions, coalesce(n_requirements, 0) AS n_requirements, coalesce(n_requirements, 0) > 2.0 * n_provisions AS dense FROM (SELECT document_id, count(*) AS n_provisions FROM provisions WHERE document_id IS NOT NULL GROUP BY document_id) p LEFT JOIN (SELECT document_id, count(*) AS n_requirements FROM requirements GROUP BY document_id) r ON r.document_id = p.document_id",
        "audit_weak_evidence": _WEAK,
        "audit_total": f"""
            SELECT f.document_id, fallback_only::INT AS n_fallback, coalesce(s.n, 0) AS n_short, coalesce(l.n, 0) AS n_duplicate_labels, coalesce(t.n, 0) AS n_toc, coalesce(w.n, 0) AS n_weak,
                   fallback_only::INT + coalesce(s.n, 0) + coalesce(l.n, 0) + coalesce(t.n, 0) + coalesce(w.n, 0) AS n_issues
            FROM ({_FALLBACK}) f LEFT JOIN (SELECT document_id, count(*) AS n FROM ({_SHORT}) GROUP BY 1) s ON s.document_id = f.document_id
            LEFT JOIN (SELECT document_id, count(*) AS n FROM ({_DUPLICATES}) GROUP BY 1) l ON l.document_id = f.document_id
            LEFT JOIN (SELECT document_id, count(*) AS n FROM ({_TOC}) WHERE reason IS NOT NULL GROUP BY 1) t ON t.document_id = f.document_id
            LEFT JOIN (SELECT document_id, count(*) AS n FROM ({_WEAK}) GROUP BY 1) w ON w.document_id = f.document_id""",
        "keyword_count": f"""SELECT keyword, sum((length(body) - length(replace(body, keyword, ''))) // length(keyword))::BIGINT AS n FROM (VALUES {', '.join(f"('{k}')" for k in KEYWORDS)}) k(keyword),
            (SELECT coalesce(text, '') AS body FROM provisions UNION ALL SELECT coalesce(title, '') FROM provisions UNION ALL SELECT coalesce(evidence.quote, '') FROM provisions UNION ALL SELECT coalesce(evidence_quote, '') FROM requirements) GROUP BY keyword""",
        "validate_documents": _FINDINGS_D,
        "validate_provisions": _FINDINGS_P,
        "validate_requirements": _FINDINGS_R,
        "validation_totals": f"SELECT level, count(*) AS n FROM ({_FINDINGS_D} UNION ALL {_FINDINGS_P} UNION ALL {_FINDINGS_R}) GROUP BY level",
        "search_substring": f"""
            SELECT * FROM (
                SELECT DISTINCT 0 AS kind_order, document_id AS id, CASE WHEN {_in('bearing', 'title')} THEN 'title' WHEN {_in('bearing', 'document_id')} THEN 'document_id' WHEN {_in('bearing', 'standard_id')} THEN 'standard_id' END AS matched_field,
                    left(CASE WHEN {_in('bearing', 'title')} THEN title WHEN {_in('bearing', 'document_id')} THEN document_id ELSE standard_id END, 200) AS hit_text FROM documents
                UNION SELECT DISTINCT 1, provision_id, CASE WHEN {_in('bearing', 'label')} THEN 'label' WHEN {_in('bearing', 'text')} THEN 'text' END, left(CASE WHEN {_in('bearing', 'label')} THEN label ELSE text END, 200) FROM provisions
                UNION SELECT DISTINCT 2, requirement_id, CASE WHEN {_in('bearing', 'evidence_quote')} THEN 'evidence_quote' END, left(evidence_quote, 200) FROM requirements
            ) WHERE matched_field IS NOT NULL AND id IS NOT NULL ORDER BY kind_order, id, matched_field, hit_text LIMIT 40""",
        "search_documents": _hits("documents", "document_id", "title", _in("标志", *_D)),
        "search_provisions": _hits("provisions", "provision_id", "text", f"{_in('制动', *_P)} AND {_in('隔热', *_P)}"),
        "search_requirements": _hits("requirements", "requirement_id", "evidence_quote", f"{_in('housing', *_R)} AND {_in('must', *_R)}"),
        "search_filtered": _hits("provisions", "provision_id", "text", f"{_in('不得', *_P)} AND review_status = 'reviewed'"),
        "search_topic_entity": _hits("provisions", "provision_id", "text", f"{_in('应', *_P)} AND EXISTS (SELECT 1 FROM tags t WHERE t.id = provision_id AND list_contains(t.topics, 'seats')) AND EXISTS (SELECT 1 FROM tags t WHERE t.id = provision_id AND list_contains(t.entities, 'component'))"),
        "search_all": f"""SELECT * FROM (
            (SELECT *, 0 AS kind_order FROM ({_hits("provisions", "provision_id", "text", _in("制动", *_P))}) ORDER BY id, snippet LIMIT 20) UNION ALL
            (SELECT *, 1 FROM ({_hits("documents", "document_id", "title", _in("制动", *_D))}) ORDER BY id, snippet LIMIT 20) UNION ALL
            (SELECT *, 2 FROM ({_hits("requirements", "requirement_id", "evidence_quote", _in("制动", *_R))}) ORDER BY id, snippet LIMIT 20)) ORDER BY kind_order, id, snippet LIMIT 20""",
        "bm25_topk": """
            WITH r AS (SELECT provision_id AS id, lower(coalesce(text, '')) AS body FROM provisions WHERE provision_id IS NOT NULL),
            f AS (SELECT * FROM (SELECT id, length(body) AS len, (length(body) - length(replace(body, 'brake', ''))) / 5 AS t0, (length(body) - length(replace(body, 'heated', ''))) / 6 AS t1 FROM r)
                QUALIFY row_number() OVER (PARTITION BY id ORDER BY len DESC, t0 DESC, t1 DESC) = 1),
            s AS (SELECT count(*) AS n, avg(len) AS mean, count(*) FILTER (t0 > 0) AS d0, count(*) FILTER (t1 > 0) AS d1 FROM f)
            SELECT id, round(score, 6) AS score FROM (SELECT id, ln(1 + (n - d0 + 0.5::DOUBLE) / (d0 + 0.5::DOUBLE)) * t0 * 2.2::DOUBLE / (t0 + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / mean))
                + ln(1 + (n - d1 + 0.5::DOUBLE) / (d1 + 0.5::DOUBLE)) * t1 * 2.2::DOUBLE / (t1 + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / mean)) AS score FROM f, s) WHERE score > 0 ORDER BY score DESC, id LIMIT 20""",
        "search_trigram": f"SELECT DISTINCT provision_id AS id FROM provisions WHERE provision_id IS NOT NULL AND {_in('bearing', 'text')}",
        "graph_nodes": f"WITH {_NODES} SELECT * FROM nodes",
        "graph_edges": f"WITH {_EDGES} SELECT * FROM edges",
        "graph_assembled": f"WITH {_NODES}, {_EDGES} SELECT type, count(*) AS n FROM edges WHERE source IN (SELECT id FROM nodes) AND target IN (SELECT id FROM nodes) GROUP BY type",
        "graph_integrity": f"WITH {_NODES}, {_EDGES} SELECT *, source AS missing FROM edges WHERE source NOT IN (SELECT id FROM nodes) UNION SELECT *, target FROM edges WHERE target NOT IN (SELECT id FROM nodes)",
        "graph_subsection": f"WITH {_SUBSECTIONS} SELECT * FROM sub",
        "graph_next": """SELECT provision_id AS source, following AS target, 'NEXT' AS type FROM (SELECT provision_id, lead(provision_id) OVER (PARTITION BY document_id ORDER BY pos_at NULLS FIRST, provision_id) AS following
            FROM (SELECT document_id, provision_id, min(locator.source_offset) AS pos_at FROM provisions WHERE provision_id IS NOT NULL AND document_id IS NOT NULL GROUP BY ALL)) WHERE following IS NOT NULL""",
        "graph_version_chain": """
            WITH RECURSIVE step AS (SELECT DISTINCT document_id, replaces FROM documents WHERE document_id IS NOT NULL AND replaces IS NOT NULL),
            reached AS (SELECT document_id, replaces AS ancestor, 1 AS steps, [document_id, replaces] AS path FROM step WHERE document_id <> replaces
                UNION ALL SELECT r.document_id, s.replaces, r.steps + 1, list_append(r.path, s.replaces) FROM reached r JOIN step s ON s.document_id = r.ancestor WHERE NOT list_contains(r.path, s.replaces))
            SELECT document_id, ancestor, min(steps) AS steps FROM reached GROUP BY ALL""",
        "graph_citations": r"""
            WITH n AS (SELECT DISTINCT regexp_replace(upper(standard_id), '[\s —–-]+', '', 'g') AS number, document_id FROM documents WHERE standard_id IS NOT NULL AND document_id IS NOT NULL),
            c AS (SELECT provision_id, regexp_replace(upper(unnest(regexp_extract_all(text, '(?:GB/T|GB|ISO|IEC|ECE R|REG) ?[0-9]+(?:\.[0-9]+)?(?:[—:/-][0-9]{4})?'))), '[\s —–-]+', '', 'g') AS number FROM provisions WHERE provision_id IS NOT NULL)
            SELECT DISTINCT provision_id AS source, document_id AS target, 'CITES' AS type FROM c JOIN n USING (number)""",
        "topic_requirements": "SELECT topic, modality, count(*) AS n FROM (SELECT DISTINCT requirement_id, provision_id, modality FROM requirements) r JOIN (SELECT DISTINCT id, topic FROM (SELECT id, unnest(topics) AS topic FROM tags) WHERE topic IS NOT NULL AND id IS NOT NULL) t ON t.id = r.provision_id GROUP BY ALL",
        "checks_run": f"WITH {_CHECKS} SELECT id, type, category, 'error' AS severity, passed FROM results",
        "check_totals": f"WITH {_CHECKS} SELECT count(*) AS total, count(*) FILTER (passed) AS n_passed, count(*) FILTER (NOT passed) AS n_failed FROM results",
        "review_mark": f"SELECT m.*, CASE WHEN r.provision_id IS NOT NULL THEN 'reviewed' ELSE 'pending' END AS review_status FROM {_MANIFEST} m LEFT JOIN {_REVIEWED} r ON r.provision_id = m.provision_id",
        "review_promote": f"SELECT m.provision_id, m.label, 'reviewed' AS review_status FROM {_MANIFEST} m JOIN {_REVIEWED} r ON r.provision_id = m.provision_id",
        "review_missing": f"SELECT r.provision_id FROM {_REVIEWED} r WHERE r.provision_id NOT IN (SELECT provision_id FROM provisions WHERE provision_id IS NOT NULL)",
        "review_pages": f"""SELECT m.provision_id, md5('---' || chr(10) || 'provision_id: ' || m.provision_id || chr(10) || 'review_status: reviewed' || chr(10) || '---' || chr(10) || chr(10) || '# ' || coalesce(m.label, '') || chr(10) || chr(10) || coalesce(p.text, '')) AS md5
            FROM {_MANIFEST} m JOIN {_REVIEWED} r ON r.provision_id = m.provision_id JOIN (SELECT provision_id, max(text) AS text FROM provisions GROUP BY provision_id) p ON p.provision_id = m.provision_id""",
        "job_updates": f"SELECT job_id, input_type, input, 'running' AS status, created_at, CASE status WHEN 'pending' THEN '2099-01-01T00:00:00Z' ELSE updated_at END AS updated_at, error FROM {_LATEST_JOB} WHERE status IN ('pending', 'running')",
        "jobs_not_found": "SELECT 'no such job' AS job_id",
        "job_creation": f"""SELECT job_id, input_type, input, status, created_at, updated_at, error FROM {_LATEST_JOB} WHERE status = 'pending'
            UNION ALL SELECT DISTINCT 'import:' || raw_path, 'pdf', raw_path, 'pending', '2099-01-01T00:00:00Z', '2099-01-01T00:00:00Z', NULL FROM documents WHERE raw_path IS NOT NULL""",
        "graph_props": " UNION ALL ".join(
            f"SELECT {key} AS id, '{kind}' AS type, unnest([{', '.join(f"'{c}'" for c in cols.split())}]) AS name, unnest([{', '.join(f"coalesce(max({c}), '')" for c in cols.split())}]) AS value FROM {name} WHERE {key} IS NOT NULL GROUP BY {key}"
            for kind, name, key, cols in (
                ("Document", "documents", "document_id", "title document_type standard_id publisher confidence review_status"), ("Provision", "provisions", "provision_id", "label kind title confidence review_status"), ("Requirement", "requirements", "requirement_id", "modality confidence review_status"),
            )
        ),
        "checks_more": f"""
            WITH {_NODES}, {_EDGES}, d AS (SELECT DISTINCT document_id FROM documents WHERE document_id IS NOT NULL),
            q AS (SELECT document_id, provision_id AS own_id, label AS own_label, '' AS provision_of, concat_ws(chr(1), text, title, evidence.quote) AS body FROM provisions
                UNION ALL SELECT document_id, requirement_id, NULL, coalesce(provision_id, ''), coalesce(evidence_quote, '') FROM requirements),
            s AS (SELECT * FROM q WHERE contains(body, 'shall') AND document_id IS NOT NULL),
            n AS (SELECT k.standard_id, arg_min(struct_pack(v := x.document_type), x.doc_id).v AS v FROM (SELECT DISTINCT standard_id FROM documents WHERE standard_id IS NOT NULL) k JOIN documents x ON x.standard_id = k.standard_id OR x.document_id = k.standard_id GROUP BY ALL),
            texts AS (SELECT unnest([text, title, evidence.quote]) AS body FROM provisions UNION ALL SELECT evidence_quote FROM requirements),
            results AS (
                SELECT 'label:' || document_id AS id, 'evidence_quote_exists' AS type, 'citation_missing' AS category, document_id IN (SELECT document_id FROM s WHERE own_label = '2.1' OR contains(provision_of, '2.1')) AS passed FROM d
                UNION ALL SELECT 'within:' || document_id, 'evidence_quote_exists', 'citation_missing', document_id IN (SELECT document_id FROM s WHERE own_label = '2-1' OR contains(provision_of, '2-1')) FROM d
                UNION ALL SELECT 'id:' || document_id, 'evidence_quote_exists', 'citation_missing', document_id IN (SELECT document_id FROM s WHERE own_id = document_id || '-1') FROM d
                UNION ALL SELECT 'node:' || document_id, 'graph_node_exists', 'export_graph', TRUE FROM d
                UNION ALL SELECT 'other:' || document_id, 'graph_node_exists', 'export_graph', FALSE FROM d
                UNION ALL SELECT 'edge:' || document_id, 'graph_edge_exists', 'export_graph', (document_id, document_id || '-1') IN (SELECT (source, target) FROM edges WHERE type = 'HAS_PROVISION') FROM d
                UNION ALL SELECT 'number:' || standard_id, 'metadata_field_equals', 'metadata_mismatch', v IS NOT DISTINCT FROM 'standard' FROM n
                UNION ALL SELECT 'keyword', 'keyword_search', 'missed_provision', (SELECT count(*) > 0 FROM texts WHERE contains(body, '制动'))
                UNION ALL SELECT 'no keyword', 'keyword_search', 'missed_provision', (SELECT count(*) > 0 FROM texts WHERE contains(body, 'zzzz'))
                UNION ALL SELECT 'table', 'sqlite_table_row_count', 'export_sqlite', (SELECT count(*) > 0 FROM jobs)
                UNION ALL SELECT 'no table', 'sqlite_table_row_count', 'export_sqlite', FALSE
                UNION ALL SELECT 'hits', 'sqlite_fts_result', 'export_sqlite', (SELECT count(*) >= 20 FROM ({_hits("provisions", "provision_id", "text", _in("制动", *_P))}))
                UNION ALL SELECT 'more hits than the limit', 'sqlite_fts_result', 'export_sqlite', FALSE
                UNION ALL SELECT 'whole graph', 'graph_edge_integrity', 'export_graph', NOT EXISTS (SELECT 1 FROM edges WHERE source NOT IN (SELECT id FROM nodes) OR target NOT IN (SELECT id FROM nodes))
            )
            SELECT id, type, category, 'warn' AS severity, passed FROM results""",
        "latest_job_state": f"SELECT job_id, status, created_at, updated_at FROM {_LATEST_JOB}",
        "job_counts": f"SELECT status, count(*) AS n FROM {_LATEST_JOB} GROUP BY status",
    }
    return out
