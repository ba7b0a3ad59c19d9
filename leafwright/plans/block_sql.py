"""SQL for the queries on blocks, as the driver's second engine runs it."""

from __future__ import annotations

from leafwright.functions import labels as L
from leafwright.plans.block_queries import CHUNK


#: Fixed values, written out here so that a wrong one in the operators shows as a difference.
CANDIDATE_FOLDED = {"image_block": "image", "chart": "image", "figure": "image", "TOC-title": "title", "section-title": "title", "fig-title": "image_caption", "fig-caption": "image_caption", "tab-title": "table_caption", "tab-caption": "table_caption"}
CANDIDATE_TEXTUAL = ("text", "list_item")
CANDIDATE_TITLES = ("title", "TOC-title", "section-title")
CANDIDATE_VISUAL = ("image_block", "image", "table", "chart", "table_footnote", "image_footnote", "table_caption", "image_caption", "title", "TOC-title", "section-title", "figure", "fig-title", "fig-caption", "tab-title", "tab-caption")
LABEL_SUPPLEMENTS = {"page_title": "page_title", "page_number": "page_number", "number": "page_number", "page_footnote": "page_footnote", "footnote": "page_footnote", "header": "header", "aside_text": "aside_text", "footer": "footer"}
LABEL_SUPPLEMENT_TYPES = ("page_title", "page_number", "page_footnote", "header", "aside_text", "footer")
NORMAL_ALLOWED = ("title", "text", "list_item", "equation", "image", "table", "image_caption", "table_caption", "image_footnote", "table_footnote", "header", "footer", "page_number", "page_footnote", "aside_text", "page_title")
TREE_COMPONENTS = ("table", "chart", "image", "seal", "image_block")
TREE_CONTD = "<|txt_contd|>"
TREE_DEFAULT_TITLE = "Default Title"
TREE_LARGE = ("super", "list", "ref_block", "equation_block", "image_block")
TREE_SPLIT = "<|txt_split|>"
TREE_VISUAL = ("table_footnote", "table", "chart", "table_caption", "image_footnote", "image", "image_caption", "seal")
TEXT_CLOSERS = '’”\'"）」】])'
TEXT_DIGIT = r"[\p{Nd}\x{B2}\x{B3}\x{B9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}\x{24EA}\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}\x{278A}-\x{2792}]"
TEXT_LIST_ITEM = r"(?i)^(?:\p{Nd}+[.)）．、]|[a-z][.)]|[一二三四五六七八九十百千万]+、|[①-⑳㉑-㉟]|[•▪▫]|[ivxlcdm]+\.|-|\$|\\t|[\[(「【（]|第[一二三四五六七八九十百千万][条节章])"
TEXT_SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\p{Z}]"
TEXT_SPLITTERS = ".。?!？！¿¡؟ฯ۔:：;；…"
TEXT_TERMINATORS = ".。?!？！¿¡؟ฯ۔:：;；"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(map(_q, values)) + ")"


B = """b AS (SELECT * EXCLUDE (rn), block_type AS type, coalesce(content, '') AS txt FROM
    (SELECT *, row_number() OVER (PARTITION BY block_key ORDER BY loaded_at DESC) AS rn FROM blocks) WHERE rn = 1)"""
S = TEXT_SPACE
SPLIT = "[" + "".join("\\" + c if c in ".?" else c for c in TEXT_SPLITTERS) + "]"


def _strip(e: str) -> str:
    return f"regexp_replace({e}, {_q(f'^{S}+|{S}+$')}, '', 'g')"


def _four(i: int) -> str:
    return f"(CASE WHEN len(bbox) >= 4 AND len(list_filter(bbox[1:4], lambda v: v IS NULL OR isnan(v))) = 0 THEN bbox[{i}] ELSE 0.0::DOUBLE END)"


def _unit(i: int, scale: str = "1000.0") -> str:
    most = f"greatest({', '.join(f'abs({_four(k)})' for k in range(1, 5))})"
    return f"least(1.0::DOUBLE, greatest(0.0::DOUBLE, CASE WHEN {most} <= 1.5 THEN {_four(i)} ELSE {_four(i)} / {scale}::DOUBLE END))"


def _thousandths() -> str:
    return " || ' ' || ".join(f"(trunc({_four(i)} * 1000)::INT)::VARCHAR" for i in (2, 1, 4, 3))


LIST_ITEM = TEXT_LIST_ITEM
DIGIT = "^" + TEXT_DIGIT
HEAD = _strip(f"regexp_extract(txt, {_q(f'^(.*?{SPLIT}|.*)')}, 1, 's')")
PARTS = f"list_filter(list_transform(string_split_regex(txt, {_q(SPLIT)}), lambda p: {_strip('p')}), lambda p: p <> '')"
TAIL = f"CASE WHEN len({PARTS}) > 0 THEN {PARTS}[-1] ELSE {_strip('txt')} END"


def _short() -> str:
    return "CASE WHEN length(both_) <= 103 THEN both_ ELSE both_[1:50] || '...' || right(both_, 50) END"


_T = _strip("txt")
CUT_OFF = f"""(txt <> '' AND length(txt) >= 10 AND NOT contains(txt, chr(9))
    AND NOT ({_T} <> '' AND contains({_q(TEXT_TERMINATORS)}, right({_T}, 1)))
    AND NOT (length({_T}) > 1 AND contains({_q(TEXT_CLOSERS)}, right({_T}, 1)) AND contains({_q(TEXT_TERMINATORS)}, right({_T}, 2)[1:1])))"""
GOES_ON = f"(txt <> '' AND NOT contains(txt, chr(9)) AND NOT regexp_matches(txt, {_q(LIST_ITEM)}))"
TEXTUAL = f"type IN {_in(CANDIDATE_TEXTUAL)}"
BARRIER = "(contains(type, 'equation') OR contains(type, 'title'))"
PAIRS = f"""f AS (SELECT doc_id, id, page, bbox, txt, {TEXTUAL} AS textual, {TEXTUAL} AND {GOES_ON} AS goes_on, regexp_matches(txt, {_q(DIGIT)}) AS digit, {CUT_OFF} AS cut_off, {BARRIER} AS barrier FROM b),
    w AS (SELECT *, min(CASE WHEN goes_on THEN id END) OVER n AS a, min(CASE WHEN goes_on AND NOT digit THEN id END) OVER n AS o, min(CASE WHEN barrier THEN id END) OVER n AS stop
        FROM f WINDOW n AS (PARTITION BY doc_id ORDER BY id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    pairs AS (SELECT doc_id, id - 1 AS idx, (CASE WHEN digit THEN o ELSE a END) - 1 AS next_idx FROM w
        WHERE textual AND cut_off AND (CASE WHEN digit THEN o ELSE a END) IS NOT NULL AND (stop IS NULL OR (CASE WHEN digit THEN o ELSE a END) < stop))"""


def _folded(e: str) -> str:
    return f"CASE {' '.join(f'WHEN {e} = {_q(a)} THEN {_q(b)}' for a, b in CANDIDATE_FOLDED.items())} ELSE {e} END"


_SUPPLEMENT = " ".join(f"WHEN source_label = {_q(k)} THEN {_q(v)}" for k, v in LABEL_SUPPLEMENTS.items())
R = f"""r0 AS (SELECT * REPLACE (CASE WHEN type = 'text' AND source_label IN {_in(LABEL_SUPPLEMENTS)} THEN CASE {_SUPPLEMENT} END ELSE type END AS type) FROM b),
    r AS (SELECT * REPLACE (CASE WHEN type = 'title' AND coalesce(level, -1) < 0 THEN 'text' ELSE type END AS type) FROM r0)"""
COMPS = f"""p0 AS (SELECT *, type = 'title' AS is_title, type NOT IN {_in(("title", *TREE_VISUAL, *TREE_LARGE, *LABEL_SUPPLEMENT_TYPES))} AS is_text FROM r),
    p1 AS (SELECT * FROM p0 WHERE is_title OR is_text),
    p2 AS (SELECT *, coalesce(max(CASE WHEN is_title THEN id END) OVER (PARTITION BY doc_id ORDER BY id), 0) AS comp FROM p1),
    tg AS (SELECT doc_id, contd AS id, min(id) AS src FROM p1 WHERE is_text AND contd >= 0 GROUP BY ALL),
    p3 AS (SELECT p2.*, CASE WHEN tg.src <= p2.id THEN '{TREE_CONTD}' ELSE '{TREE_SPLIT}' END AS mark FROM p2 LEFT JOIN tg ON tg.doc_id = p2.doc_id AND tg.id = p2.id),
    p4 AS (SELECT *, min(CASE WHEN is_text AND txt <> '' THEN id END) OVER (PARTITION BY doc_id, comp) AS first_text FROM p3),
    c0 AS (SELECT doc_id, comp AS comp_id, coalesce(max(CASE WHEN is_title THEN txt END), '{TREE_DEFAULT_TITLE}') AS title,
        coalesce(string_agg(CASE WHEN is_text THEN CASE WHEN first_text IS NULL OR id < first_text THEN '' WHEN id = first_text THEN txt ELSE mark || txt END END, '' ORDER BY id), '') AS content,
        coalesce(max(CASE WHEN is_title THEN level END), 1) AS level, string_agg(id::VARCHAR, ',' ORDER BY id) AS block_ids FROM p4 GROUP BY doc_id, comp),
    comps AS (SELECT * EXCLUDE (most) FROM (SELECT *, max(comp_id) OVER (PARTITION BY doc_id) AS most FROM c0) WHERE comp_id > 0 OR content <> '' OR most = 0)"""
VIS = f"""v0 AS (SELECT doc_id, id AS vis_id, type, txt, image AS link FROM r WHERE type IN {_in(TREE_COMPONENTS)}),
    vx AS (SELECT doc_id, image AS vis_id, string_agg(CASE WHEN contains(type, 'caption') AND txt <> '' THEN txt END, ' ' ORDER BY id) AS title,
        string_agg(CASE WHEN NOT contains(type, 'caption') AND contains(type, 'footnote') AND txt <> '' THEN txt END, ' ' ORDER BY id) AS metadata,
        string_agg(id::VARCHAR, ',' ORDER BY id) AS ids, list(id ORDER BY id) AS idl FROM r WHERE image >= 0 AND (contains(type, 'caption') OR contains(type, 'footnote')) GROUP BY ALL),
    vis AS (SELECT v0.doc_id, v0.vis_id, v0.type, coalesce(vx.title, '') AS title, coalesce(vx.metadata, '') AS metadata, v0.link, v0.vis_id::VARCHAR || coalesce(',' || ids, '') AS block_ids, list_concat([v0.vis_id], coalesce(idl, [])) AS idl
        FROM v0 LEFT JOIN vx ON vx.doc_id = v0.doc_id AND vx.vis_id = v0.vis_id)"""
TITLES = f"""t AS (SELECT doc_id, id - 1 AS idx, page, txt[1:50] AS content, {_thousandths()} AS box FROM b WHERE type IN {_in(CANDIDATE_TITLES)})"""
# adaptive chunks: one step per border
RANGES = f"""ct AS (SELECT doc_id, page, count(*) AS n FROM t WHERE page IS NOT NULL GROUP BY ALL),
    d AS (SELECT doc_id, min(page) AS first, max(page) AS last FROM ct GROUP BY doc_id),
    st(doc_id, first, last, no, cur, a, z) AS (
        SELECT doc_id, first, last, -1, first, NULL::INT, NULL::INT FROM d
        UNION ALL
        SELECT doc_id, first, last, no + 1, nxt, CASE WHEN no = -1 THEN first ELSE cur - 1 END, least(last, nxt + 1) FROM (
            SELECT s.*, coalesce(
                (SELECT arg_max(page, n * 100000 - page) FROM ct WHERE ct.doc_id = s.doc_id AND page BETWEEN greatest(first, cur + {CHUNK - 5}) AND least(last, cur + {CHUNK + 5})),
                (SELECT min(page) FROM ct WHERE ct.doc_id = s.doc_id AND page > cur + {CHUNK}), last) AS nxt
            FROM st s WHERE cur < last) x),
    ranges AS (SELECT doc_id, no AS chunk_no, a AS start_, z AS end_ FROM st WHERE no >= 0 UNION ALL SELECT doc_id, 0, first, last FROM d WHERE first = last)"""
TABLE_PAIRS = """tp AS (SELECT doc_id, page, max(id) AS last, min(id) AS first FROM b WHERE type = 'table' GROUP BY ALL),
    pairs AS (SELECT u.doc_id, u.last - 1 AS upper_idx, l.first - 1 AS lower_idx, u.page FROM tp u JOIN tp l ON l.doc_id = u.doc_id AND l.page = u.page + 1)"""
STATUS = """st AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, model ORDER BY checked_at DESC, status DESC, message DESC NULLS LAST, n_blocks DESC NULLS LAST) AS rn FROM doc_status) WHERE rn = 1)"""
_MARKS = "<\\|txt_split\\|>|<\\|txt_contd\\|>"
TRUTH = f"""bt AS (SELECT doc_id, id, page, block_id, txt, type, {", ".join(f"{_unit(i)} AS u{i}" for i in range(1, 5))} FROM b WHERE type = 'title')"""


def _area(p: str) -> str:
    return f"(greatest(0.0::DOUBLE, {p}3 - {p}1) * greatest(0.0::DOUBLE, {p}4 - {p}2))"


_BOTH = "(greatest(0.0::DOUBLE, least(a3, b3) - greatest(a1, b1)) * greatest(0.0::DOUBLE, least(a4, b4) - greatest(a2, b2)))"
_VISUAL = f"""t AS (SELECT doc_id, id - 1 AS idx, page, {_folded('type')} AS kind FROM b WHERE type IN {_in(CANDIDATE_VISUAL)})"""
_IN = "JOIN ranges ON ranges.doc_id = t.doc_id AND page BETWEEN start_ AND end_"
_LABELS = ", ".join(f"({_q(v)}, {_q(lab)}, {_q(c)}, {_q(s)})" for v, lab, c, s in L.label_rows())


_CAPTION_NUMBERS = " ".join(
    f"WHEN regexp_matches(cap, '{p}') THEN '{k} ' || upper(regexp_replace(regexp_extract(cap, '{p}', 1), '[ -]', '', 'g'))"
    for k, p in (
        ("Exhibit", "[Ee]xhibit\\s*([0-9]+)"), ("Exhibit", "EXHIBIT\\s*([0-9]+)"), ("Table", "[Tt]able\\s*([A-Za-z]?\\s*-?\\s*[0-9.]+)"), ("Table", "[Tt]ab\\.?\\s*([A-Za-z]?\\s*-?\\s*[0-9.]+)"), ("Table", "TABLE\\s*([A-Za-z]?\\s*-?\\s*[0-9.]+)"),
        ("Table", "表\\s*([A-Za-z]?\\s*-?\\s*[0-9.]+)"), ("Figure", "[Ff]igure\\s*([0-9]+)"), ("Figure", "图\\s*([0-9]+)"), ("CN", "^([一二三四五六七八九十]+)、"),
    )
)
ATTACHED = """held AS (SELECT doc_id, vis_id AS outer_, unnest(idl) AS link FROM vis),
    nest AS (SELECT vis.doc_id, vis.vis_id, min(outer_) AS outer_ FROM vis JOIN held ON held.doc_id = vis.doc_id AND held.link = vis.link WHERE vis.link >= 0 AND outer_ <> vis.vis_id GROUP BY ALL),
    home AS (SELECT doc_id, comp_id, unnest(string_split(block_ids, ','))::INT AS link FROM comps),
    bef AS (SELECT vis.doc_id, vis.vis_id, max(r.id) AS t FROM vis JOIN r ON r.doc_id = vis.doc_id AND r.type = 'title' AND r.id < list_min(vis.idl) WHERE vis.link < 0 GROUP BY ALL),
    ax AS (SELECT vis.doc_id, vis.vis_id, outer_, CASE WHEN vis.link >= 0 THEN vis.link ELSE t END AS link FROM vis LEFT JOIN nest ON nest.doc_id = vis.doc_id AND nest.vis_id = vis.vis_id LEFT JOIN bef ON bef.doc_id = vis.doc_id AND bef.vis_id = vis.vis_id),
    att AS (SELECT ax.doc_id, ax.vis_id, CASE WHEN outer_ IS NOT NULL THEN 'visual' WHEN comp_id IS NOT NULL THEN 'text' ELSE 'root' END AS parent_kind, coalesce(outer_, comp_id, -1)::BIGINT AS parent_id FROM ax LEFT JOIN home ON home.doc_id = ax.doc_id AND home.link = ax.link)"""
PARENTS = """lv AS (SELECT doc_id, comp_id, CASE WHEN level > 0 THEN level ELSE 100 END AS lv FROM comps),
    par AS (SELECT c.doc_id, c.comp_id::BIGINT AS comp_id, coalesce(max(p.comp_id), -1)::BIGINT AS parent_id FROM lv c LEFT JOIN lv p ON p.doc_id = c.doc_id AND p.comp_id < c.comp_id AND p.lv < c.lv GROUP BY ALL)"""
SUPPLEMENTS = f"""su AS (SELECT doc_id, id, type, page, txt, row_number() OVER (PARTITION BY doc_id, page, type ORDER BY id) - 1 AS n FROM r WHERE type IN {_in(LABEL_SUPPLEMENT_TYPES)}),
    sup AS (SELECT doc_id, id, type, 'Page ' || page || ' - ' || type || CASE WHEN n > 0 THEN ' - ' || n ELSE '' END AS title, txt AS content FROM su)"""
PATHS = """cp(doc_id, comp_id, path) AS (SELECT doc_id, comp_id, '0' || lpad(comp_id::VARCHAR, 10, '0') FROM par WHERE parent_id = -1
        UNION ALL SELECT par.doc_id, par.comp_id, cp.path || '/0' || lpad(par.comp_id::VARCHAR, 10, '0') FROM par JOIN cp ON cp.doc_id = par.doc_id AND cp.comp_id = par.parent_id),
    vp(doc_id, vis_id, path) AS (SELECT a.doc_id, a.vis_id, coalesce(cp.path || '/', '') || '1' || lpad(a.vis_id::VARCHAR, 10, '0') FROM att a LEFT JOIN cp ON cp.doc_id = a.doc_id AND cp.comp_id = a.parent_id AND a.parent_kind = 'text' WHERE a.parent_kind <> 'visual'
        UNION ALL SELECT a.doc_id, a.vis_id, vp.path || '/1' || lpad(a.vis_id::VARCHAR, 10, '0') FROM att a JOIN vp ON vp.doc_id = a.doc_id AND vp.vis_id = a.parent_id WHERE a.parent_kind = 'visual'),
    nodes AS (SELECT doc_id, path, title, content FROM comps JOIN cp USING (doc_id, comp_id) UNION ALL SELECT vp.doc_id, path, title, txt FROM vp JOIN vis USING (doc_id, vis_id) JOIN v0 USING (doc_id, vis_id)
        UNION ALL SELECT doc_id, '2' || lpad(id::VARCHAR, 10, '0'), title, content FROM sup)"""
TRUNCATED = f"""{PAIRS}, sides AS (SELECT doc_id, idx, 2 * idx AS ord FROM pairs UNION ALL SELECT doc_id, next_idx, 2 * idx + 1 FROM pairs), one AS (SELECT doc_id, idx, min(ord) AS ord FROM sides GROUP BY ALL),
    t AS (SELECT one.*, b.page FROM one JOIN b ON b.doc_id = one.doc_id AND b.id = one.idx + 1)"""
CELLS = """tr AS (SELECT doc_id, id, string_split(txt, '<tr>')[2:] AS rs FROM b WHERE type = 'table'), tr2 AS (SELECT doc_id, id, unnest(rs) AS r, generate_subscripts(rs, 1) - 1 AS row_ FROM tr),
    tc AS (SELECT doc_id, id, row_, regexp_extract_all(r, '<t[dh]>(.*?)</t[dh]>', 1) AS cs FROM tr2), cells AS (SELECT doc_id, id, row_::INT AS row_, (generate_subscripts(cs, 1) - 1)::INT AS cell, trim(unnest(cs)) AS text FROM tc)"""


def oracle_sql() -> dict[str, str]:
    title_level = "coalesce(level, 0)"
    reason = f"""CASE WHEN type IS NULL OR type NOT IN {_in(NORMAL_ALLOWED)} THEN 'type' WHEN len(coalesce(bbox, [])) <> 4 THEN 'length'
        WHEN len(list_filter(bbox, lambda v: v IS NULL OR isnan(v) OR isinf(v))) > 0 THEN 'number' WHEN bbox[3] < bbox[1] OR bbox[4] < bbox[2] THEN 'order'
        WHEN len(list_filter(bbox, lambda v: v < -1e-6 OR v > 1.000001)) > 0 THEN 'range' END"""
    out = {
        "normalize_text": f"WITH {B} SELECT block_key, {_strip(f'regexp_replace(txt, {_q(S + chr(43))}, chr(32), {_q(chr(103))})')} AS content FROM b",
        "bbox_scale": f"WITH {B} SELECT block_key, {', '.join(f'round({_unit(i)}, 6) AS {n}' for i, n in ((1, 'x1'), (2, 'y1'), (3, 'x2'), (4, 'y2')))} FROM b",
        "bbox_thousandths": f"WITH {B} SELECT block_key, {_thousandths()} AS box FROM b",
        "label_map": f"""WITH {B}, m(vendor, label, canonical, sub_type) AS (VALUES {_LABELS}), v AS (SELECT DISTINCT vendor FROM m), s AS (SELECT DISTINCT source_label FROM b WHERE source_label IS NOT NULL),
            x AS (SELECT v.vendor, s.source_label, CASE WHEN v.vendor = 'dolphin' THEN CASE WHEN regexp_matches(source_label, '^sec_[1-9][0-9]*$') THEN TRY_CAST(source_label[5:13] AS INT) WHEN source_label = 'catalogue' THEN 1 END END AS lv FROM v CROSS JOIN s
                WHERE NOT (v.vendor IN ('mineru', 'monkeyocr') AND source_label IN {_in(L.SKIPPED)}))
            SELECT x.vendor, x.source_label, CASE WHEN lv IS NOT NULL THEN 'title' ELSE coalesce(canonical, 'text') END AS canonical, CASE WHEN lv IS NOT NULL THEN 'title' ELSE coalesce(sub_type, 'text') END AS sub_type, lv AS label_level
            FROM x LEFT JOIN m ON m.vendor = x.vendor AND m.label = x.source_label""",
        "validate_blocks": f"WITH {B} SELECT block_key, {reason} AS reason FROM b WHERE {reason} IS NOT NULL",
        "block_order": f"WITH {B} SELECT block_key, row_number() OVER (PARTITION BY doc_id ORDER BY page NULLS FIRST, block_order NULLS LAST, {_four(2)}, {_four(1)}, block_key) AS number FROM b",
        "sentence_head_tail": f"""WITH {B}, s AS (SELECT block_key, {HEAD} AS head, {TAIL} AS tail FROM b WHERE {TEXTUAL}), s2 AS (SELECT *, CASE WHEN head = tail THEN head ELSE head || ' ... ' || tail END AS both_ FROM s)
            SELECT block_key, head, tail, {_short()} AS short FROM s2""",
        "merge_rule_flags": f"WITH {B} SELECT block_key, regexp_matches(txt, {_q(LIST_ITEM)}) AS list_item, {CUT_OFF} AS cut_off, {GOES_ON} AS goes_on, regexp_matches(txt, {_q(DIGIT)}) AS digit FROM b WHERE {TEXTUAL}",
        "truncation_candidates": f"WITH {B}, {PAIRS} SELECT * FROM pairs",
        "truncation_rows": f"""WITH {B}, {PAIRS}, sides AS (SELECT doc_id, idx, 2 * idx AS ord FROM pairs UNION ALL SELECT doc_id, next_idx, 2 * idx + 1 FROM pairs), one AS (SELECT doc_id, idx, min(ord) AS ord FROM sides GROUP BY ALL),
            s AS (SELECT one.*, page, {_thousandths()} AS box, {HEAD} AS head, {TAIL} AS tail FROM one JOIN b ON b.doc_id = one.doc_id AND b.id = one.idx + 1), s2 AS (SELECT *, CASE WHEN head = tail THEN head ELSE head || ' ... ' || tail END AS both_ FROM s)
            SELECT doc_id, ord, idx, page, box, {_short()} AS content FROM s2""",
        "title_candidates": f"WITH {B}, {TITLES} SELECT doc_id, idx, page, content FROM t",
        "visual_candidates": f"""WITH {B} SELECT doc_id, id - 1 AS idx, {_folded('type')} AS type, page, CASE WHEN {_folded('type')} IN ('image', 'table') THEN 'None' ELSE txt END[1:50] AS content FROM b WHERE type IN {_in(CANDIDATE_VISUAL)}""".replace("END[1:50]", "END AS c0").replace(
            "SELECT doc_id, id - 1 AS idx", "SELECT doc_id, idx, type, page, c0[1:50] AS content FROM (SELECT doc_id, id - 1 AS idx").replace(" AS content FROM b WHERE", " FROM b WHERE") + ")",
        "containment_links": f"""WITH {B}, x AS (SELECT doc_id, id, type, {_four(1)} AS b1, {_four(2)} AS b2, {_four(3)} AS b3, {_four(4)} AS b4 FROM b)
            SELECT i.doc_id, i.id - 1 AS idx, min(o.id) - 1 AS large_idx FROM x i JOIN x o ON o.doc_id = i.doc_id AND o.id <> i.id AND o.type IN ('table', 'image_block') AND i.type IN ('image_caption', 'table_caption', 'image')
                AND i.b1 >= 0.95::DOUBLE * o.b1 AND i.b2 >= 0.95::DOUBLE * o.b2 AND i.b3 <= 1.05::DOUBLE * o.b3 AND i.b4 <= 1.05::DOUBLE * o.b4 GROUP BY ALL""",
        "table_pairs": f"WITH {B}, {TABLE_PAIRS} SELECT doc_id, upper_idx, lower_idx FROM pairs",
        "table_screen_text_between": f"""WITH {B}, {TABLE_PAIRS}, tx AS (SELECT doc_id, page, min(id) AS lo, max(id) AS hi FROM b WHERE type IN ('text', 'list_item', 'list') GROUP BY ALL)
            SELECT p.doc_id, upper_idx, lower_idx, coalesce(u.hi > upper_idx + 1, FALSE) AS text_after, coalesce(l.lo < lower_idx + 1, FALSE) AS text_before FROM pairs p LEFT JOIN tx u ON u.doc_id = p.doc_id AND u.page = p.page LEFT JOIN tx l ON l.doc_id = p.doc_id AND l.page = p.page + 1""",
        "table_screen_caption": f"""WITH {B}, {TABLE_PAIRS}, cp AS (SELECT doc_id, id, CASE WHEN type IN ('table_caption', 'tab-title', 'tab-caption', 'title') OR (type = 'text' AND length({_strip('txt')}) < 150
                AND regexp_matches({_strip('txt')}, '(?i)^(table|表|exhibit|figure|图)\\s*[0-9]+|^[0-9]+(\\.[0-9]+)*\\s+|^[一二三四五六七八九十]+、')) THEN {_strip('txt')} END AS cap FROM b),
            cn AS (SELECT *, CASE {_CAPTION_NUMBERS} END AS num FROM cp)
            SELECT p.doc_id, upper_idx, lower_idx, u.cap AS cap1, l.cap AS cap2, u.num AS number1, l.num AS number2 FROM pairs p LEFT JOIN cn u ON u.doc_id = p.doc_id AND u.id = upper_idx LEFT JOIN cn l ON l.doc_id = p.doc_id AND l.id = lower_idx""",
        "table_screen_footnotes": f"""WITH {B}, {TABLE_PAIRS}, s AS (SELECT p.doc_id, upper_idx, lower_idx, min(CASE WHEN b.type NOT IN ('table_footnote', 'table_caption', 'tab-caption', 'tab-title') AND b.id > upper_idx + 1 THEN b.id END) AS stop, max(b.id) AS page_end
            FROM pairs p JOIN b ON b.doc_id = p.doc_id AND b.page = p.page GROUP BY p.doc_id, upper_idx, lower_idx) SELECT doc_id, upper_idx, lower_idx, (coalesce(stop, page_end + 1) - upper_idx - 2)::BIGINT AS notes FROM s""",
        "table_screen_width": f"""WITH {B}, {TABLE_PAIRS}, wd AS (SELECT doc_id, id, {_four(3)} - {_four(1)} AS w FROM b) SELECT p.doc_id, upper_idx, lower_idx, round(u.w, 6) AS width1, round(l.w, 6) AS width2
            FROM pairs p JOIN wd u ON u.doc_id = p.doc_id AND u.id = upper_idx + 1 JOIN wd l ON l.doc_id = p.doc_id AND l.id = lower_idx + 1""",
        "chunk_pages": f"""WITH RECURSIVE {B}, {TITLES}, {RANGES} SELECT doc_id, chunk_no, string_agg(page::VARCHAR, ',' ORDER BY page) AS pages FROM (SELECT DISTINCT t.doc_id, chunk_no, page FROM t {_IN}) GROUP BY ALL""",
        "input_labels": "SELECT doc_id, CASE WHEN input_label <> '' THEN input_label ELSE doc_id::VARCHAR END AS label FROM documents",
        "tree_locations": f"""WITH {B}, {R}, {COMPS}, x AS (SELECT p4.doc_id, comp AS comp_id, id, page, bbox FROM p4 JOIN comps ON comps.doc_id = p4.doc_id AND comps.comp_id = p4.comp)
            SELECT doc_id, comp_id, (row_number() OVER (PARTITION BY doc_id, comp_id ORDER BY id) - 1)::INT AS pos, id, page, round(bbox[1], 6) AS x1, round(bbox[4], 6) AS y2 FROM x""",
        "chunk_ranges": f"""WITH RECURSIVE {B}, {TITLES}, {RANGES} SELECT doc_id, chunk_no, start_ AS "start", end_ AS "end" FROM ranges""",
        "chunk_items": f"WITH RECURSIVE {B}, {TITLES}, {RANGES} SELECT t.doc_id, chunk_no, idx, page FROM t JOIN ranges ON ranges.doc_id = t.doc_id AND page BETWEEN start_ AND end_",
        "prompt_text": f"""WITH {B}, {TITLES} SELECT doc_id, 'Title Level Analysis: ' || string_agg('<|id|>' || idx || '<|page|>' || page || '<|box|>' || box || '<|content|>' || content, chr(10) ORDER BY page, idx) AS prompt FROM t GROUP BY doc_id""",
        "parse_levels": f"""WITH RECURSIVE {B}, {TITLES}, {RANGES} SELECT t.doc_id, chunk_no, idx, 1 + idx % 4 AS level FROM t JOIN ranges ON ranges.doc_id = t.doc_id AND page BETWEEN start_ AND end_ WHERE idx % 7 <> 0""",
        # the rule model gives a title the same level in every chunk, so that the common scale is its own
        "level_sync": f"WITH RECURSIVE {B}, {TITLES}, {RANGES} SELECT DISTINCT t.doc_id, idx, 1 + idx % 4 AS level FROM t {_IN} WHERE idx % 7 <> 0",
        "apply_links": f"""WITH {B}, cl AS (WITH RECURSIVE {TRUNCATED}, {RANGES}, x AS (SELECT t.doc_id, chunk_no, idx AS src, lead(idx) OVER w AS tgt, row_number() OVER w AS pos FROM t {_IN} WINDOW w AS (PARTITION BY t.doc_id, chunk_no ORDER BY page, ord))
                SELECT doc_id, src, tgt, min(chunk_no * 1000000 + pos) AS o FROM x WHERE (src + tgt) % 3 = 0 GROUP BY ALL),
            ll AS (WITH RECURSIVE {TITLES}, {RANGES} SELECT DISTINCT t.doc_id, idx, 1 + idx % 4 AS level FROM t {_IN} WHERE idx % 7 <> 0),
            il AS (WITH RECURSIVE {_VISUAL}, {RANGES}, x AS (SELECT t.doc_id, chunk_no, idx, kind, last_value(CASE WHEN kind = 'title' THEN idx END IGNORE NULLS) OVER w AS tgt, row_number() OVER w AS pos FROM t {_IN}
                WINDOW w AS (PARTITION BY t.doc_id, chunk_no ORDER BY page, idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT doc_id, idx AS src, tgt, min(chunk_no * 1000000 + pos) AS o FROM x WHERE kind <> 'title' AND tgt IS NOT NULL GROUP BY ALL),
            c AS (SELECT doc_id, src, arg_max(tgt, o) + 1 AS v FROM cl GROUP BY ALL), i AS (SELECT doc_id, src, arg_max(tgt, o) + 1 AS v FROM il GROUP BY ALL)
            SELECT block_key, coalesce(c.v, -1) AS contd, coalesce(ll.level, -1) AS level, coalesce(i.v, -1) AS image FROM b LEFT JOIN c ON c.doc_id = b.doc_id AND c.src = b.id - 1 LEFT JOIN i ON i.doc_id = b.doc_id AND i.src = b.id - 1 LEFT JOIN ll ON ll.doc_id = b.doc_id AND ll.idx = b.id - 1""",
        "training_cases": f"""WITH {B}, {TITLES}, q AS (SELECT doc_id, '<image>' || chr(10) || 'Title Level Analysis: ' || string_agg('<|id|>' || idx || '<|page|>' || page || '<|box|>' || box || '<|content|>' || content, chr(10) ORDER BY page, idx) AS human FROM t GROUP BY doc_id),
            a AS (SELECT doc_id, string_agg('<|id|>' || (id - 1) || '<|level|>' || level, chr(10) ORDER BY id) AS gpt FROM b WHERE type = 'title' AND level >= 0 GROUP BY doc_id)
            SELECT q.doc_id, '{{"image":"","conversations":[{{"from":"human","value":' || to_json(human)::VARCHAR || '}},{{"from":"gpt","value":' || to_json(coalesce(gpt, ''))::VARCHAR || '}}],"type":"grounding"}}' AS "case" FROM q LEFT JOIN a ON a.doc_id = q.doc_id""",
        "table_shapes": f"""WITH {B}, h AS (SELECT doc_id, id, (length(txt) - length(replace(txt, '<tr>', ''))) / 4 AS r, (length(txt) - length(replace(replace(txt, '<td', ''), '<th', ''))) / 3 AS c FROM b WHERE type = 'table')
            SELECT doc_id, id, r::BIGINT AS n_rows, c::BIGINT AS n_cells, (c / r)::BIGINT AS n_cols FROM h WHERE c > 0""",
        "text_components": f"WITH {B}, {R}, {COMPS} SELECT * FROM comps",
        "tree_parents": f"WITH {B}, {R}, {COMPS}, {PARENTS} SELECT * FROM par",
        "tree_visuals": f"WITH {B}, {R}, {VIS} SELECT * EXCLUDE (idl) FROM vis",
        "tree_attached": f"WITH {B}, {R}, {COMPS}, {VIS}, {ATTACHED} SELECT * FROM att",
        "tree_supplements": f"WITH {B}, {R}, {SUPPLEMENTS} SELECT * FROM sup",
        "tree_preview": f"""WITH RECURSIVE {B}, {R}, {COMPS}, {PARENTS}, {VIS}, {ATTACHED}, {SUPPLEMENTS}, {PATHS}
            SELECT doc_id, path, repeat('    ', len(string_split(path, '/'))) || title || '|' || CASE WHEN length(content) > 30 THEN content[1:30] || '...' ELSE content END AS line FROM nodes
            UNION ALL SELECT DISTINCT doc_id, '', '|' FROM nodes""",
        "parse_links": f"""WITH RECURSIVE {B}, {TRUNCATED}, {RANGES}, x AS (SELECT t.doc_id, chunk_no, idx AS src, lead(idx) OVER (PARTITION BY t.doc_id, chunk_no ORDER BY page, ord) AS tgt FROM t JOIN ranges ON ranges.doc_id = t.doc_id AND page BETWEEN start_ AND end_)
            SELECT * FROM x WHERE (src + tgt) % 3 = 0""",
        "gt_parse": f"""WITH {B}, {TRUTH} SELECT doc_id, (id - 1)::VARCHAR AS gt_id, page, {" || ' ' || ".join(f"trunc(u{i} * 0.98::DOUBLE * 1000)::INT || '.0'" for i in range(1, 5))} AS box,
            {_strip(f"regexp_replace(txt[1:200], {_q(S + chr(43))}, ' ', 'g')")} AS content FROM bt""",
        "table_cells": f"WITH {B}, {CELLS} SELECT doc_id, id, row_ AS \"row\", cell, cell AS col, text FROM cells",
        "table_header_rows": f"""WITH {B}, {TABLE_PAIRS}, {CELLS}, k AS (SELECT doc_id, id, row_, cell, regexp_replace(text, '\\s', '', 'g') AS v FROM cells WHERE row_ < 5),
            u AS (SELECT p.doc_id, upper_idx + 1 AS a, lower_idx + 1 AS z, row_, cell, v FROM pairs p JOIN k ON k.doc_id = p.doc_id AND k.id = upper_idx + 1), w AS (SELECT p.doc_id, upper_idx + 1 AS a, lower_idx + 1 AS z, row_, cell, v FROM pairs p JOIN k ON k.doc_id = p.doc_id AND k.id = lower_idx + 1),
            j AS (SELECT coalesce(u.doc_id, w.doc_id) AS doc_id, coalesce(u.a, w.a) AS upper_id, coalesce(u.z, w.z) AS lower_id, coalesce(u.row_, w.row_) AS row_, u.v IS NOT DISTINCT FROM w.v AS same FROM u FULL JOIN w ON u.doc_id = w.doc_id AND u.a = w.a AND u.z = w.z AND u.row_ = w.row_ AND u.cell = w.cell)
            SELECT doc_id, upper_id, lower_id, coalesce(min(CASE WHEN NOT same THEN row_ END), max(row_) + 1)::INT AS n_header FROM j GROUP BY ALL""",
        "relations": f"""WITH {B} SELECT doc_id, 'contd' AS kind, id AS src, contd AS tgt FROM b WHERE contd >= 0 UNION ALL SELECT doc_id, 'image', id, image FROM b WHERE image >= 0
            UNION ALL SELECT doc_id, 'title', id, level FROM b WHERE type = 'title' AND level >= 0""",
        "relation_records": f"""WITH {B}, x AS (SELECT doc_id, 'contd' AS kind, id AS src, contd AS tgt FROM b WHERE contd >= 0 UNION ALL SELECT doc_id, 'image', id, image FROM b WHERE image >= 0
            UNION ALL SELECT doc_id, 'title', id, level FROM b WHERE type = 'title' AND level >= 0), y AS (SELECT doc_id, kind, string_agg('[' || src || ',' || tgt || ']', ',' ORDER BY src, tgt) AS p FROM x GROUP BY ALL)
            SELECT doc_id, '{{' || string_agg('"' || kind || '":[' || p || ']', ',' ORDER BY kind) || '}}' AS record FROM y GROUP BY doc_id""",
        "subnode_split": f"""WITH RECURSIVE n AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY node_key ORDER BY loaded_at DESC) AS rn FROM sub_com_trees) WHERE rn = 1 AND node_type = 'text' AND length(content) > 500),
            s AS (SELECT node_key, coalesce(title, '{TREE_DEFAULT_TITLE}') AS title, block_ids, list_filter(string_split_regex(content, {_q(_MARKS)}), lambda x: x <> '') AS segs FROM n),
            g(node_key, i, sub, acc) AS (SELECT node_key, 1, 1, segs[1] FROM s
                UNION ALL SELECT g.node_key, i + 1, CASE WHEN length(acc) > 500 THEN sub + 1 ELSE sub END, CASE WHEN length(acc) > 500 THEN segs[i + 1] ELSE acc || segs[i + 1] END FROM g JOIN s ON s.node_key = g.node_key WHERE i < len(segs)),
            e AS (SELECT node_key, sub, arg_max(acc, i) AS content, list(i ORDER BY i) AS at_ FROM g GROUP BY ALL), c AS (SELECT *, count(*) OVER (PARTITION BY node_key) AS k FROM e)
            SELECT c.node_key, c.sub::INT AS sub_no, c.content, coalesce(array_to_string(list_filter(CASE WHEN title = '{TREE_DEFAULT_TITLE}' THEN list_transform(at_, lambda j: block_ids[j]) ELSE list_concat([block_ids[1]], list_transform(at_, lambda j: block_ids[j + 1])) END, lambda v: v IS NOT NULL), ','), '') AS block_ids
            FROM c JOIN s ON s.node_key = c.node_key WHERE k > 1""",
        "title_linking": f"""WITH {B}, l AS (SELECT doc_id, id, CASE WHEN type = 'title' THEN {title_level} ELSE 0 END AS lv FROM b)
            SELECT c.doc_id, (c.id - 1)::BIGINT AS idx, coalesce(max(p.id) - 1, 0)::BIGINT AS to_idx FROM l c LEFT JOIN l p ON p.doc_id = c.doc_id AND p.id > 1 AND p.id < c.id AND p.lv > 0 AND (CASE WHEN c.lv > 0 AND c.id > 1 THEN p.lv < c.lv ELSE TRUE END) GROUP BY ALL""",
        "level_marks": f"""WITH {B} SELECT doc_id, id, CASE WHEN type = 'title' AND {title_level} <= 0 THEN 'text' ELSE type END AS type, CASE WHEN type = 'title' AND {title_level} > 0 THEN repeat('#', level) || ' ' || txt ELSE txt END AS marked FROM b""",
        "box_iou": f"""WITH {B}, {TRUTH}, a AS (SELECT doc_id, page, (id - 1)::VARCHAR AS gt_id, {", ".join(f"trunc(u{i} * 0.98::DOUBLE * 1000)::DOUBLE AS a{i}" for i in range(1, 5))} FROM bt), c AS (SELECT doc_id, page, block_id, {", ".join(f"u{i} * 1000.0::DOUBLE AS b{i}" for i in range(1, 5))} FROM bt)
            SELECT a.doc_id, gt_id, block_id, round(CASE WHEN {_area('a')} + {_area('b')} - {_BOTH} > 0 THEN {_BOTH} / ({_area('a')} + {_area('b')} - {_BOTH}) ELSE 0 END, 6) AS iou,
                round(CASE WHEN least({_area('a')}, {_area('b')}) > 0 THEN {_BOTH} / least({_area('a')}, {_area('b')}) ELSE 0 END, 6) AS smaller FROM a JOIN c ON c.doc_id = a.doc_id AND c.page = a.page""",
        "eval_summary": f"""WITH {STATUS}, sc AS (SELECT doc_id, max(coalesce(n_blocks, 0)) / 1000.0::DOUBLE AS score FROM st GROUP BY doc_id)
            SELECT model, count(*) AS n_docs, count(*) FILTER (status = 'ok') AS n_ok, round(avg(score) FILTER (status = 'ok'), 6) AS mean_ok, round(avg(CASE WHEN status = 'ok' THEN score ELSE 0 END), 6) AS mean_all FROM st JOIN sc USING (doc_id) GROUP BY model""",
        "doc_status": f"WITH {STATUS} SELECT doc_id, model, status, message, n_blocks FROM st",
        "resume_anti_join": f"WITH {STATUS} SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM st WHERE status = 'ok')",
        "doc_ids": "SELECT doc_id FROM documents UNION SELECT doc_id FROM blocks UNION SELECT doc_id FROM trees",
    }
    # the test tables have no spans, so that both kinds of header rows are the same
    return out | {"table_visual_header_rows": out["table_header_rows"]}
