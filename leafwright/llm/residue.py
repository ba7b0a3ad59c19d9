"""Problem 8: template residue, filler, error pages and script notices instead of content.

Every text is cut into units: its lines, and the sentences of lines that hold several. Units run through a prefix
tree of fixed depth: the number of tokens, then the first tokens one by one; all units of a leaf are one template, whose
later tokens are wildcards wherever the units differ. Patterns of known messages, fillers and page furniture are
seeds only. Each template is classified once, over all texts: by the share of its units that are seeds, else
by its support, its place, and the share of its texts that are made of messages only. The verdicts go back to the
texts. Apart from that, ordinary records are searched for unresolved slots and for filler words. A document is residue
if it has a slot or filler where content should be, or if nothing but messages and furniture is left of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from re import _parser

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from leafwright.llm.lookalike import one_form
from leafwright.runtime import salted_join, written

#: The tree's levels below the number of tokens: so many first tokens.
DEPTH = 4
#: A template without seeds is judged from so many different texts on; it is a message, or filler, if this share of them is.
SUPPORT, SHARE = 3, 0.8
#: A template whose units are seeds of one kind in this share has that verdict.
SEEDED = 0.5
#: Kinds of seeds; `message` is the verdict of a template that no seed told.
KINDS = ("error", "script", "filler", "furniture")
MESSAGES = ("error", "script", "message")
#: Leaves a task's tree holds before it is handed on.
_FLUSH = 100_000

#: How error messages read, by language.
ERRORS = re.compile(
    r"""(?x)
    \b(?:error|erreur|fehler|ошибка|错误)\s*:?\s*(?:\#|<\*>|[45]\d\d) | \b(?:http|status)\s*:?\s*(?:\#|<\*>)\s | ^(?:\#|<\*>)\s*:?\s*(?:not\s+found|forbidden|unauthorized|bad\s+(?:gateway|request)|gone|页面不存在|nicht\s+gefunden|introuvable|no\s+encontrad|не\s+найден)
  | \bpage\s+(?:not\s+found|moved\s+or\s+deleted|introuvable|cannot\s+be\s+(?:found|displayed)) | \bpage\s+(?:is\s+)?no\s+longer\s+available | p[áa]gina\s+no\s+(?:encontrada|existe|disponible) | seite\s+(?:wurde\s+)?nicht\s+gefunden | страница\s+не\s+найдена | 页面不存在 | 未找到(?:页面|该页) | 找不到(?:页面|该页)
  | internal\s+server\s+error | interner\s+serverfehler | erreur\s+interne\s+du\s+serveur | error\s+interno\s+del\s+servidor | внутренняя\s+ошибка\s+сервера | 服务器(?:内部)?错误
  | access\s+denied | zugriff\s+verweigert | acc[èe]s\s+refus[ée] | acceso\s+denegado | доступ\s+(?:запрещ[её]н|закрыт) | 拒绝访问 | (?:do\s+not|don't)\s+have\s+permission | keine\s+berechtigung
  | session\s+(?:has\s+)?(?:expired|timed\s+out) | sitzung\s+(?:ist\s+)?abgelaufen | session\s+(?:a\s+)?expir[ée]e? | sesi[óo]n\s+(?:ha\s+)?(?:caducado|expirado) | (?:сеанс|сессия)\s+(?:ист[её]к|истекла|завершен) | 会话已?(?:过期|超时)
  | gateway\s+time-?out | bad\s+gateway | request\s+timed?\s*out | connection\s+(?:refused|reset|timed\s+out) | could\s+not\s+(?:connect|be\s+(?:opened|rendered|loaded|found)) | (?:service|server|site)\s+(?:is\s+)?(?:temporarily\s+)?unavailable | dienst\s+(?:ist\s+)?(?:vorübergehend\s+)?nicht\s+verfügbar | service\s+(?:temporairement\s+)?indisponible | servicio\s+no\s+disponible | сервис\s+(?:временно\s+)?недоступен | 服务(?:暂时)?不可用 | 稍后再试
  | was\s+not\s+found\s+on\s+this\s+(?:server|site) | konnte\s+nicht\s+(?:geladen|geöffnet|angezeigt|gefunden|verbunden|hergestellt)\s+werden | n['’]a\s+pas\s+pu\s+être\s+(?:chargé|ouvert|affiché|trouvé|établi) | no\s+se\s+(?:pudo|ha\s+podido)\s+(?:cargar|abrir|mostrar|conectar|encontrar) | не\s+удалось\s+(?:загрузить|открыть|показать|подключиться|найти) | 无法(?:加载|打开|显示|连接|访问) | (?:加载|打开|连接)失败
  | pagina\s+non\s+trovata | página\s+não\s+encontrada | ページが見つかりません | (?:site|service|system)\s+(?:is\s+)?(?:down\s+for|under(?:going)?)\s+(?:\w+\s+)?maintenance | (?:verify|confirm|prove)\s+(?:that\s+)?you\s+are\s+(?:a\s+)?(?:human|not\s+a\s+robot)
  | page\s+can(?:['’]t|not)\s+be\s+(?:found|displayed|reached) | too\s+many\s+requests | unhandled\s+exception | stack\s*trace | null\s+pointer | something\s+went\s+wrong | unexpected\s+(?:error|end\s+of\s+data) | moved\s+or\s+deleted
    """
)
#: How notices that scripts or cookies are needed read.
SCRIPTS = re.compile(
    r"""(?x)
    (?:enable|activate|turn\s+on|switch\s+on|allow|requires?|needs?|without)\s+(?:java\s?script|js|scripts?|scripting|cookies)\b | (?:java\s?script|scripting|scripts?|cookies)\s+(?:is|are|must\s+be|has\s+been)\s+(?:disabled|switched\s+off|turned\s+off|blocked|required|needed|enabled) | scripts?\s+(?:allowed|execution\s+is\s+blocked) | (?:not|n't)\s+support\s+(?:scripting|java\s?script) | ^noscript\b
  | javascript,?\s+um\s+ | (?:aktivieren\s+sie|benötigt|erfordert)\s+(?:\w+\s+)?(?:java\s?script|skripte) | skripte\s+(?:sind|müssen|zulassen)
  | activer\s+(?:le\s+)?java\s?script | scripts\s+sont\s+(?:désactivés|bloqués) | active\s+(?:el\s+)?java\s?script | habilit[ea]r?\s+java\s?script | necesita\s+(?:java\s?)?scripts? | включите\s+(?:java\s?script|скрипты) | скрипты\s+(?:отключены|заблокированы) | (?:启用|开启|打开|需要)\s*(?:java\s?script|脚本) | 脚本(?:已)?(?:禁用|被阻止)
    """
)
#: Filler in place of a text or heading.
FILLERS = re.compile(
    r"""(?x)
    ^x{3,}(?:[\s.]+x{3,})+[\s.]*$ | ^x{6,}[\s.]*$ | ^(?:asdf[\s.]*){2,}$ | ^(?:tbd[\s.,]*){2,}$ | ^(?:todo[\s.,]*){2,}$ | ^(?:bla[\s.,]*){3,}$ | ^(?:foo\s+bar[\s.]*)+$ | ^(?:test[\s.,]*){3,}$
  | ^(?:your\s+)?text\s+goes\s+here | ^replace\s+this\s+(?:paragraph|text|section) | ^(?:insert|enter|type|add)\s+(?:your\s+)?(?:text|title|content|heading)\s+here | ^describe\s+the\s+\S+\s+in\s+(?:two|three|a\s+few|\d|\#)\s+sentences | ^(?:sample|example|dummy)\s+(?:heading|title|text)\.?$ | ^placeholder(?:\s+text)?\.?$ | ^(?:heading|title)\s+goes\s+here
  | ^hier\s+(?:steht|kommt)\s+ihr\s+text | ^beispiel(?:überschrift|titel|text)\.?$ | ^(?:blindtext|platzhalter(?:text)?)\.?$ | ^titre\s+d['’]exemple | ^saisissez\s+votre\s+texte | ^votre\s+texte\s+ici | ^texte\s+d['’]exemple | ^título\s+de\s+ejemplo | ^escriba\s+aquí | ^texto\s+de\s+(?:ejemplo|relleno) | ^введите\s+(?:здесь\s+)?(?:ваш\s+)?текст | ^(?:пример|образец)\s+(?:заголовка|текста)\.?$ | ^请在此处?输入 | ^示例(?:标题|文本|正文) | ^此处(?:填写|输入)
    """
)
#: Furniture of a viewer's page, which is no content.
FURNITURE = re.compile(
    r"""(?x)
    ^(?:menu|menü|menú|home|viewer(?:\s+\#)?|help|terms|contact|documents|sign\s+in|log\s?in|back(?:\s+to\s+\w+)?|next|search|close|print|share|cookies?|privacy|imprint|impressum|retry|reload|ref\.?\s*:?\s*\S+|(?:\w+\s*[|·»>]\s*)+\w+|(?:see\s+)?(?:page|seite|página|стр\.)\s+\#|-+|\#)\.?$ | ^(?:please|try|then\s+(?:try|reload)|contact|check|return|go\s+back|reload|refresh|bitte|veuillez|por\s+favor|пожалуйста|请|prego|riprova\w*)\b
    """
)
#: The words of the usual dummy text.
DUMMY_WORDS = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum mollis".split()
)
#: Those of them that are no common words elsewhere, nor parts of such ones (official, temporary, minimum); a dummy text has one.
_TELLING = tuple(sorted(w for w in DUMMY_WORDS if len(w) > 4 and w not in ("officia", "tempor", "minim")))
_NAME = r"[^\W\d]\w*(?:[.\-]\w+)*"
#: Slots that nothing else looks like, and slots whose name must look like one.
STRONG_SLOT = re.compile(rf"(?=[{{$\[<%@_])(?:\{{\{{\s*{_NAME}\s*\}}\}}|\$\{{\s*{_NAME}\s*\}}|\[(?:INSERT|insert|Insert)\s+[^\[\]\n]{{1,40}}\]|<<\s*{_NAME}\s*>>|%%{_NAME}%%|@@{_NAME}@@|%\({_NAME}\)s|<%=?\s*{_NAME}\s*%>|__{_NAME}__|\[(?:Your|your|YOUR)\s+[^\[\]\n]{{1,40}}\]|<[A-Z][a-z]+(?:\s[A-Z][a-z]+)+>|\{{%-?\s*{_NAME}[^%\n]*%\}})")
WEAK_SLOT = re.compile(rf"(?=[\[{{<#])(?<![\w\[{{<])(?:\[(?P<a>{_NAME})\]|\{{(?P<b>{_NAME})\}}|<(?P<c>{_NAME})>|\#(?P<d>{_NAME})\#)(?![\w(\]}}>])")
#: Names of slots, as they are without an underscore, a dot or capitals.
SLOT_NAMES = frozenset(
    "date name title author department recipient client customer company address city country phone email signature amount number subject reference version project datum name titel autor abteilung empfaenger empfänger kunde firma adresse ort betreff betrag nom titre auteur service destinataire client société adresse ville objet montant fecha nombre titulo título autor departamento destinatario cliente empresa direccion dirección ciudad asunto importe дата имя название автор отдел получатель клиент компания адрес 日期 姓名 标题 作者 部门 收件人 客户 公司 地址".split()
)
#: Words of sentences that speak about such strings.
_TALK = re.compile(r"(?i)\b(?:token|placeholders?|is\s+replaced|are\s+replaced|explains?\s+that|mail\s+merge|syntax|variables?|such\s+as|so-called|platzhalter|wird\s+ersetzt|jeton|balise|marcador|variable|est\s+remplacé|se\s+sustituye|заменяется|переменн\w+)\b|占位符|会被替换|变量")
_SENTENCE_END = re.compile(r"(?<=[.!?。！？])\s+|\r\n|[\n\r]|(?<=[。！？])")
#: A run of one letter amid other sentences may be a masked or blackened word; as a line of its own it is filler.
_RUN = re.compile(r"x+[\s.]*")
_STOP = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])")
_LINES = re.compile(r"\r\n|[\n\r\v\f\x85  ]")
_DIGITS = re.compile(r"\d+(?:[.,]\d+)*")
_HAN = re.compile(r"([぀-ヿ㐀-鿿])")


def _required(pattern) -> set[str] | None:
    """Literals of a parsed pattern of which every match holds one; the set whose shortest literal is longest, None if there is none."""
    found: list[set[str]] = []
    literal = ""
    for op, arg in [*pattern, (None, None)]:
        name = str(op)
        if name == "LITERAL":
            literal += chr(arg)
            continue
        if literal:
            found.append({literal})
            literal = ""
        inner: list | None = None
        if name == "SUBPATTERN":
            inner = [arg[-1]]
        elif name == "BRANCH":
            inner = arg[1]
        elif name in ("MAX_REPEAT", "POSSESSIVE_REPEAT", "MIN_REPEAT") and arg[0] > 0:
            inner = [list(arg[2]) * arg[0]]
        if inner and all((sets := [_required(x) for x in inner])):
            found.append(set().union(*sets))
    return max(found, key=lambda s: min(map(len, s)), default=None)


def _alternatives(pattern: re.Pattern) -> list[re.Pattern]:
    """The alternatives of a verbose pattern, each compiled by itself."""
    out, depth, part, skip, inside = [], 0, "", False, False
    for c in pattern.pattern.partition("(?x)")[2]:
        inside = (inside or c == "[") and not (c == "]") if not skip else inside
        if not skip and not inside:
            depth += (c == "(") - (c == ")")
        if c == "|" and not depth and not skip and not inside:
            out.append(part)
            part = ""
        else:
            part += c
        skip = c == "\\" and not skip
    return [re.compile("(?x)" + a) for a in (*out, part)]


def _automaton() -> ahocorasick.Automaton:
    """From each literal to the alternatives that need it, and to None for a telling word of dummy text."""
    by: dict[str, list] = {w: [None] for w in _TELLING}
    for kind, pattern in (("filler", FILLERS), ("script", SCRIPTS), ("error", ERRORS)):
        for alternative in _alternatives(pattern):
            for w in _required(_parser.parse(alternative.pattern, re.VERBOSE)):
                by.setdefault(w, []).append((kind, alternative))
    out = ahocorasick.Automaton()
    for w, found in by.items():
        out.add_word(w, tuple(found))
    out.make_automaton()
    return out


_AUTOMATON = _automaton()


def masked_lines(text: str) -> list[str]:
    """Lines in lower case with plain characters and numbers masked; blank ones are left out."""
    plain = (one_form(text) or "").lower()
    return [line for line in _LINES.split(_DIGITS.sub("#", plain)) if line and not line.isspace()]


def sentences(line: str) -> list[str]:
    """The sentences of a line; fewer than three tokens before a stop are a short form and stay with what follows."""
    out: list[str] = []
    part = ""
    for s in _STOP.split(line):
        part = f"{part} {s}" if part else s
        if part.count(" ") > 1 or part.endswith(("。", "！", "？")):
            out.append(part)
            part = ""
    if part and not part.isspace():
        out.append(part)
    return out


def tokens(unit: str) -> list[str]:
    """Tokens of a unit; a Han or Kana letter is one by itself."""
    return (unit if unit.isascii() else _HAN.sub(r" \1 ", unit)).split()


class PrefixTree:
    """number of tokens -> first token -> .. -> token DEPTH -> the leaf's template, count and seeds."""

    def __init__(self) -> None:
        self.leaves: dict[int, list] = {}

    @staticmethod
    def leaf(t: list[str]) -> int:
        """The leaf's number, the same in every task: a hash of its path, in which a token with digits is a wildcard."""
        return xxh64_intdigest(f"{len(t)} {' '.join('<*>' if '#' in x else x for x in t[:DEPTH])}") - (1 << 63)

    def add(self, t: list[str]) -> None:
        at = self.leaf(t)
        known = self.leaves.get(at)
        if known is None:
            self.leaves[at] = [t, 1]
            return
        known[1] += 1
        if known[0] != t:
            known[0] = [a if a == b else "<*>" for a, b in zip(known[0], t, strict=True)]


def seed(unit: str) -> str | None:
    """error, script or filler by the patterns, or None; sentences that speak about such strings are none."""
    return _seed(unit, _found(unit))


def _found(text: str) -> set:
    """The alternatives that can match in the text, each once, and None if a word tells dummy text."""
    return {x for _, found in _AUTOMATON.iter(text) for x in found}


def _seed(unit: str, candidates: set) -> str | None:
    kinds = {x[0] for x in candidates if x and x[1].search(unit)}
    if "filler" in kinds:
        return "filler"
    if not kinds or _TALK.search(unit):
        return None
    return "script" if "script" in kinds else "error"


@lru_cache(maxsize=1 << 16)
def furniture(unit: str) -> bool:
    return bool(FURNITURE.search(unit)) and not _TALK.search(unit)


def _is_advice(parts: list[str], seeds: list[str | None], i: int) -> bool:
    """Whether a sentence stands beside a message in its line and is no longer than that, as in "Session expired. Sign in again."."""
    beside = [parts[k] for k in (i - 1, i + 1) if 0 <= k < len(parts) and seeds[k] in ("error", "script")]
    return any(len(parts[i].split()) <= len(p.split()) for p in beside) and not _TALK.search(parts[i])


class Reading:
    """What one text tells: its units with their seeds, and whether it holds dummy text."""

    def __init__(self, text: str) -> None:
        self.units: list[tuple[str, str | None]] = []
        self.dummy = False
        for line in masked_lines(text):
            parts = sentences(line)
            found = _found(line)
            seeds: list[str | None] = [None] * len(parts)
            if found:
                seeds = [seed(s) for s in parts] if len(parts) > 1 else [_seed(parts[0].strip(), found)]
                if len(parts) > 1 and "filler" in seeds:
                    told = any(_TALK.search(s) for s, v in zip(parts, seeds, strict=True) if v != "filler")
                    quoted = [v == "filler" and bool(told or _RUN.fullmatch(s)) for s, v in zip(parts, seeds, strict=True)]
                    # what a line only speaks about goes to branches of its own, so that no verdict from elsewhere reaches it
                    parts = [f"“ {s}" if q else s for s, q in zip(parts, quoted, strict=True)]
                    seeds = [None if q else v for v, q in zip(seeds, quoted, strict=True)]
                self.dummy = self.dummy or (None in found and has_dummy_text(line))
            for i, (s, v) in enumerate(zip(parts, seeds, strict=True)):
                self.units.append((s, v or ("furniture" if furniture(s.strip()) or (found and _is_advice(parts, seeds, i)) else None)))


_TELL = frozenset(_TELLING)


def has_dummy_text(text: str) -> bool:
    """Whether five words in a row or more, and most of a sentence or line, are words of the usual dummy text."""
    for part in _SENTENCE_END.split(text.lower()):
        w = re.findall(r"[a-z]+", part)
        if len(w) >= 5 and sum(x in DUMMY_WORDS for x in w) >= 0.7 * len(w) and len(w) * 3 >= len(part.split()) and not _TELL.isdisjoint(w):
            return True
    return False


def has_slot(text: str) -> bool:
    """Whether an unresolved slot stands in the text, other than in a sentence that speaks about such strings."""
    if not any(c in text for c in ("{", "[", "<", "%", "@@", "__", "#")):
        return False
    found = [m.start() for m in STRONG_SLOT.finditer(text)]
    for m in WEAK_SLOT.finditer(text):
        name = next(x for x in m.groups() if x)
        if "_" in name or "." in name or (name.isupper() and len(name) > 2) or name.casefold() in SLOT_NAMES:
            found.append(m.start())
    if not found:
        return False
    at = 0
    ends = [*_SENTENCE_END.finditer(text)]
    for begin, end in zip([0, *(m.end() for m in ends)], [*(m.start() for m in ends), len(text)], strict=True):
        if any(begin <= x < max(end, begin + 1) for x in found) and not _TALK.search(text, begin, end):
            return True
        at = end
    return at < 0


_ROWS = "doc_id long, rec long, other string, leaves array<long>, seeds array<tinyint>"


def read_documents(docs: DataFrame) -> DataFrame:
    """doc_id, rec, other, leaves, seeds: a row per document with its text's number, the leaves its units fall into, each unit's
    seed as a place in KINDS (-1: none), and `slot` or `filler` if it holds a slot or dummy text. Whole texts are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for d, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                r = Reading(text)
                other = "slot" if has_slot(text) else "filler" if r.dummy else None
                values = (d, xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63), other, [PrefixTree.leaf(tokens(u)) for u, _ in r.units], [KINDS.index(s) if s else -1 for _, s in r.units])
                for col, v in zip(rows, values, strict=True):
                    col.append(v)
            types = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int8()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], ["doc_id", "rec", "other", "leaves", "seeds"])

    return docs.mapInArrow(run, _ROWS)


def text_units(rows: DataFrame) -> DataFrame:
    """rec, leaf, told, and a count per kind of seed: each leaf of each different text once, however many documents have the text."""
    told = F.exists("seeds", lambda s: s >= 0)
    u = rows.select("rec", told.alias("told"), F.explode(F.arrays_zip("leaves", "seeds")).alias("u")).select("rec", "told", F.col("u.leaves").alias("leaf"), F.col("u.seeds").alias("seed"))
    return u.groupBy("rec", "leaf").agg(F.bool_or("told").alias("told"), *[F.bool_or(F.col("seed") == i).alias(k) for i, k in enumerate(KINDS)])


def leaf_verdicts(units: DataFrame) -> DataFrame:
    """leaf, n, verdict, learned: each template classified once, from all texts; templates of ordinary text are left out.

    n is the number of different texts. A template whose units are seeds of a kind in half of them is of that kind, unless it
    is a message with support of whose texts hardly one is made of messages only: ordinary text quotes it. Any other one is a message if it has support and SHARE of its texts hold nothing but seeded and supported templates, at least
    one seeded; it is filler if SHARE of its texts hold seeded filler.
    """
    support = written(units.groupBy("leaf").agg(F.count("*").alias("n"), *[F.count_if(k).alias(k) for k in KINDS]), "residue_leaves")
    by_seed = F.coalesce(*[F.when(F.col(k) >= SEEDED * F.col("n"), k) for k in KINDS])
    own = support.select("leaf", "n", by_seed.alias("verdict"))
    of_told = salted_join(units.filter("told").select("rec", "leaf", "filler"), own, "leaf", "inner")
    texts = of_told.groupBy("rec").agg(F.bool_and((F.col("n") >= SUPPORT) | F.col("verdict").isNotNull()).alias("closed"), F.bool_or("filler").alias("filled"))
    marked = texts.filter("closed or filled")
    shares = units.filter("told").select("rec", "leaf").join(marked, "rec").groupBy("leaf").agg(F.count_if(F.col("closed") & ~F.col("filled")).alias("closed"), F.count_if("filled").alias("filled"))
    quoted = F.col("verdict").isin(*MESSAGES) & (F.col("n") >= SUPPORT) & (F.coalesce("closed", F.lit(0)) <= (1 - SHARE) * F.col("n"))
    j = own.join(shares, "leaf", "left").withColumn("verdict", F.when(~F.coalesce(quoted, F.lit(False)), F.col("verdict"))).withColumn("quoted", F.coalesce(quoted, F.lit(False)))
    enough = F.col("n") >= SUPPORT
    enough = enough & ~F.col("quoted")
    learned = F.when(enough & (F.col("filled") >= SHARE * F.col("n")), "filler").when(enough & (F.col("closed") >= SHARE * F.col("n")), "message")
    return j.select("leaf", "n", F.coalesce("verdict", learned).alias("verdict"), F.col("verdict").isNull().alias("learned")).filter("verdict is not null")


def residues(documents: DataFrame) -> DataFrame:
    """doc_id, kind (message, filler, slot) of all documents that are residue; repeated rows count once.

    Null, empty and blank texts are none, nor are texts that only speak about such strings; rows without a doc_id
    are left out. Documents meet their verdicts as numbers of texts and leaves; no text is shuffled, no table broadcast.
    """
    docs = documents.select(F.col("doc_id").cast("long"), "text").filter("text <> '' and doc_id is not null")
    rows = written(read_documents(docs), "residue_rows")
    units = written(text_units(rows), "residue_units")
    verdicts = written(leaf_verdicts(units), "residue_verdicts").select("leaf", "verdict")
    told = salted_join(units.select("rec", "leaf"), verdicts, "leaf", "inner")
    texts = told.groupBy("rec").agg(F.count("*").alias("n"), F.bool_or(F.col("verdict").isin(*MESSAGES)).alias("message"), F.bool_or(F.col("verdict") == "filler").alias("filler")).filter("message or filler")
    j = rows.select("doc_id", "rec", "other", F.size(F.array_distinct("leaves")).alias("n_units")).join(texts, "rec", "left")
    kind = F.when(F.col("filler"), "filler").when(F.col("message") & (F.col("n") == F.col("n_units")), "message").otherwise(F.col("other"))
    return j.select("doc_id", kind.alias("kind")).filter("kind is not null").distinct()


def mined_templates(documents: DataFrame) -> DataFrame:
    """leaf, template, n: the templates of the leaves with a verdict, with wildcards wherever their units differ, and their verdicts.

    Tasks build trees of their own; trees are merged leaf by leaf and token by token, which no order changes.
    """
    docs = documents.select(F.col("doc_id").cast("long"), "text").filter("text <> '' and doc_id is not null")
    verdicts = leaf_verdicts(written(text_units(read_documents(docs)), "residue_units"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = PrefixTree()

        def flush() -> pa.RecordBatch:
            rows = [(k, t) for k, (t, _) in tree.leaves.items()]
            tree.leaves.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.string()))], ["leaf", "tokens"])

        for b in batches:
            for text in b.column("text").to_pylist():
                for unit, _ in Reading(text).units:
                    tree.add(tokens(unit))
            if len(tree.leaves) > _FLUSH:
                yield flush()
        yield flush()

    mined = docs.select("text").mapInArrow(run, "leaf long, tokens array<string>").join(verdicts, "leaf", "left_semi")
    per_token = mined.select("leaf", F.posexplode("tokens").alias("pos", "token")).groupBy("leaf", "pos").agg(F.min("token").alias("lo"), F.max("token").alias("hi"))
    token = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise("<*>")
    templates = per_token.groupBy("leaf").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", token.alias("t")))), lambda x: x["t"]), " ").alias("template"))
    return templates.join(verdicts, "leaf").select("template", "n", "verdict", "learned")


def without_residue(documents: DataFrame) -> DataFrame:
    """The documents that are no residue, all columns."""
    return documents.join(residues(documents).select("doc_id").distinct(), "doc_id", "left_anti")
