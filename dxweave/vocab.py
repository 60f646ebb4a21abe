"""Vocabularies of the obstetric domain pack.

Everything the cleaners, predicates and lookups need to know about the language of the
data lives here as plain values.  A pack is an ordinary frozen dataclass, so another
domain passes its own instance instead of editing code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must be exactly these strings for results to agree.
# ---------------------------------------------------------------------------

# Column names.
INDICATION_COLUMN = "手术适应症"
COMPLICATION_COLUMN = "产科合并症"
RISK_COLUMN = "孕期风险项"
PARITY_COLUMN = "产次"
CODE_SUFFIX = "_ICD11_Code"

# Cells that carry no information at all.
CELL_PLACEHOLDERS = (
    "/", "／", "其他", "其他 /", "无", "其它", "其它 /", "其他的", "无并发症",
    "珍贵儿", "孕妇及家属要求", "要求手术", "nan", "none", "None",
)
ARCHIVED_CELL_PLACEHOLDERS = (
    "/", "／", "其他", "其他 /", "无", "其它", "其它 /", "其他的", "无并发症", "nan", "None",
)
RISK_CELL_PLACEHOLDERS = ("/", "其他", "其他 /", "无", "其它", "其它 /")
INDICATION_CELL_PLACEHOLDERS = (
    "/", "其他", "其他 /", "无", "其它", "其它 /", "／", "珍贵儿", "社会因素", "足月成熟儿",
)

# Terms that are not a diagnosis (compared in lower case).
STOP_TERMS = (
    "", "/", "／", "无", "其他", "其它", "其他 /", "其它 /", "其他的", "无并发症",
    "珍贵儿", "孕妇及家属要求", "要求手术", "nan", "none", "妊娠",
)
ARCHIVED_STOP_TERMS = (
    "", "/", "／", "无", "其他", "其它", "其他 /", "其它 /", "其他的", "无并发症", "nan", "none",
)

# Whole-term patterns for gestation, parity, delivery mode and supervision entries.
# \p{Nd} is any decimal digit; (?d) below makes "." stop at a line feed only.
NON_DISEASE_PATTERNS = (
    r"孕\p{Nd}+(?:\+\p{Nd}+)?周",
    r"孕\p{Nd}+次",
    r"产\p{Nd}+次",
    r"(?:单|双|多)胎活产",
    r"单一活产",
    r"头位顺产",
    r"单胎顺产",
    r"经(?:选择性|急症)?剖宫产术?的?分娩",
    r"经剖宫产术分娩",
    r"经剖宫产术的分娩",
    r"早产经剖宫产",
    r"产钳助产的单胎分娩",
    r"提前自然临产伴有足月产",
    r"提前自然临产伴有早产",
    r"早产伴分娩",
    r"高危妊娠监督",
    r"正常妊娠监督",
    r"具有.*妊娠监督",
    r".*妊娠状态",
)
SUPERVISION_KEYWORD = "监督"
SUPERVISION_KEEP_PATTERNS = (
    r"高龄初孕妇的监督",
    r"高龄经产妇妊娠监督",
    r"高龄初孕.*监督",
    r"高龄经产.*监督",
)

OTHER_PREFIXES = ("其他", "其它")
REMOVABLE_PHRASES = ("孕妇及家属要求", "要求手术", "珍贵儿")

# Words that join two diagnoses, and words inside which they do not.
CONNECTORS = ("并", "并发", "伴", "伴有", "合并", "及", "和", "与")
LEXICON = (
    "妊娠期糖尿病", "妊娠期高血压", "子痫前期", "重度子痫前期", "胎膜早破", "胎盘早剥",
    "胎儿窘迫", "胎儿生长受限", "急性绒毛膜羊膜炎", "前置胎盘", "甲状腺功能减退",
    "甲状腺功能亢进", "妊娠合并", "凶险性前置胎盘",
)

# Characters.
TERM_SEPARATORS = ",，;；|、?？ \n\r\t"
ARCHIVED_TERM_SEPARATORS = ",，;；|、\n\r\t"
OPENING_BRACKETS = "(（[【{"
CLOSING_BRACKETS = ")）]】}"
EDGE_CHARACTERS = " ，,;；|"

# Risk-item cells.
RISK_MARKER_PATTERN = r"\([^)]*色\)"
RISK_SYSTEM_PREFIXES = (
    "血液系统疾病：", "内分泌系统疾病：", "循环系统疾病：", "呼吸系统疾病：",
    "消化系统疾病：", "泌尿系统疾病：", "神经系统疾病：", "其他系统疾病：",
)
RISK_STOP_TERMS = ("其他", "其它", "/")

# Complication cells (archived profile).
COMPLICATION_SIZE_PATTERN = r"\p{Nd}+(?:\.\p{Nd}+)?x\p{Nd}+(?:\.\p{Nd}+)?cm"
COMPLICATION_STOP_TERMS = (
    "其他", "其它", "/", "其他 /", "其它 /", "珍贵儿", "社会因素", "足月成熟儿",
)
COMPLICATION_PREFIX = "妊娠合并"

# Indication cells (archived profile).
CORD_PATTERNS = (r"脐带绕颈\p{Nd}+周", r"脐带扭转\p{Nd}+周")
CAUSE_WORD = "查因"
INDICATION_REQUEST_PHRASES = (
    "孕妇要求手术", "患者要求手术", "孕妇要求", "患者要求", "要求手术", "孕妇选择",
)
INDICATION_STOP_TERMS = ("其他", "其它", "无")
WEEK_WORD = "周"

# Inspection.
EXPLICIT_NOISE_TERMS = ("无",)
NOISE_EMPTY = "标准化后为空"
NOISE_EXPLICIT = "显式噪声词"
NOISE_PUNCTUATION = "仅包含标点或噪声字符"
DETAIL_MISSING_CODE = "有诊断但编码为空"
DETAIL_MISSING_TERM = "有编码但诊断为空"
DETAIL_ERROR_CODE = "编码结果包含 ERROR"
DETAIL_EMPTY_CODE = "编码为空或None"
DETAIL_MULTI_CODE = "term=%s 出现多编码；major=%s(%d) current=%s(%d)"
TEMPLATE_PLACEHOLDER = ("示例诊断词", "示例错误编码", "示例正确编码", "请按需填写")

# Messages of the coding cascade.
ERROR_NO_MAPPING = "ERROR: No mapping for '"
ERROR_SPLIT = "Splitting/Translation failed: Invalid JSON format."
ERROR_NO_CANDIDATES = "No API results"
ERROR_SELECTION = "Selection failed"

# Risk items whose code depends on the sibling columns.
RISK_EXCLUDED_TOKENS = (
    "无需药物治疗的糖尿病、甲状腺疾病、垂体泌乳素瘤等",
    "需药物治疗的糖尿病、甲状腺疾病、垂体泌乳素瘤",
)
RISK_EXCLUSION_KEYWORDS = ("甲亢", "甲减", "垂体", "甲")
RISK_OVERRIDE_TOKEN = "凶险性前置胎盘，胎盘早剥"
RISK_OVERRIDE_A = ("胎盘早剥", "JA8C.Z")
RISK_OVERRIDE_B = ("凶险性前置胎盘", "JA8A.2|JA8B.1")

# Code groups: declared order decides, a member matches as a prefix.
CODE_GROUPS = {
    "胎膜早破 (PROM)": ("JA89.1", "JA89.Z"),
    "妊娠期高血压疾病": ("JA20", "JA21", "JA22", "JA23", "JA24", "JA25", "JA2Z"),
    "胎先露异常": (
        "JA82.1", "JA82.2", "JA82.3", "JA82.4", "JA82.5", "JA82.6", "JA82.Y", "JA82.Z",
    ),
    "妊娠期糖尿病": ("JA63.2", "JA63.Y"),
    "宫内生长受限": ("KA20.1Y", "KA20.10", "KA20.11", "KA20.12", "KA20.1Z"),
    "产后出血": ("JA43.1", "JA43.Y", "JA43.1/JB02.2"),
    "滞产": ("JB03.1", "JB03.0", "JB03.2", "JB03.Z"),
}
# code, label when the parity column is "0", label otherwise
PARITY_RELABEL = (
    "JA84.2",
    "JA84.2 & QA42.0 (非产源性瘢痕/初次妊娠)",
    "JA84.2 (剖宫产后瘢痕)",
)

# Spellings a CSV reader turns into null, per dialect.
NA_SPELLINGS = {
    "pandas": (
        "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
        "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
    ),
    "polars": ("",),
}

# ---------------------------------------------------------------------------
# Packs
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class DiagnosisVocab:
    """What the diagnosis cleaners drop, trim and split on."""

    separators: str = TERM_SEPARATORS
    stop_terms: tuple[str, ...] = STOP_TERMS
    drop_patterns: tuple[str, ...] = NON_DISEASE_PATTERNS
    drop_keyword: str | None = SUPERVISION_KEYWORD
    keep_patterns: tuple[str, ...] = SUPERVISION_KEEP_PATTERNS
    leading_words: tuple[str, ...] = OTHER_PREFIXES
    phrases: tuple[str, ...] = REMOVABLE_PHRASES
    connectors: tuple[str, ...] = CONNECTORS
    lexicon: tuple[str, ...] = LEXICON
    edge_characters: str = EDGE_CHARACTERS
    # Segmented output carries no blanks in the language this pack is for.
    squeeze_chunks: bool = True


@dataclass(frozen=True)
class RiskVocab:
    """What the risk-item cleaner splits on and drops."""

    marker_pattern: str = RISK_MARKER_PATTERN
    prefixes: tuple[str, ...] = RISK_SYSTEM_PREFIXES
    stop_terms: tuple[str, ...] = RISK_STOP_TERMS


@dataclass(frozen=True)
class ContextRules:
    """Risk items that depend on what the sibling columns say."""

    excluded_tokens: tuple[str, ...] = RISK_EXCLUDED_TOKENS
    exclusion_keywords: tuple[str, ...] = RISK_EXCLUSION_KEYWORDS
    override_token: str = RISK_OVERRIDE_TOKEN
    override_a: tuple[str, str] = RISK_OVERRIDE_A
    override_b: tuple[str, str] = RISK_OVERRIDE_B


@dataclass(frozen=True)
class CodeGroups:
    """Groups in declared order, and the code that is relabelled before counting."""

    groups: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(CODE_GROUPS))
    relabel: tuple[str, str, str] | None = PARITY_RELABEL


OBSTETRIC = DiagnosisVocab()
OBSTETRIC_ARCHIVED = DiagnosisVocab(
    separators=ARCHIVED_TERM_SEPARATORS,
    stop_terms=ARCHIVED_STOP_TERMS,
    phrases=(),
    connectors=(),
    lexicon=(),
)
