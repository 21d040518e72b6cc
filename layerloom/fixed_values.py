"""Fixed values of the corpus format.

Every list below is data that must equal the published corpus for results to agree: enum
members, display labels, section names, headings and marker strings.
"""

# Claim predicates and the tag shown for each in a chapter index.
PREDICATE_LABELS = {
    "analogous_to": "類似",
    "alludes_to": "暗喩",
    "parodies": "パロディ",
    "structurally_matches": "構造対応",
    "inverts": "逆転",
    "sublates": "止揚",
    "foreshadows": "伏線",
}
PREDICATES = list(PREDICATE_LABELS)

# Evidence strengths, weakest first. The ranking is ours; the members are the corpus's.
EVIDENCE_LEVELS = ["weak", "moderate", "strong", "explicit"]

# Ledger confidences: the first two are applied, the last is only reported.
EXPLICIT = "明言"
SAME_SPELLING = "表記一致"
UNVERIFIED = "要検証"
APPLIED_CONFIDENCES = [EXPLICIT, SAME_SPELLING]

# Verbs inside observation ids. Some hold an underscore.
OBSERVATION_VERBS = [
    "activates", "appears", "appears_as", "arrives", "asks", "attacks", "binds", "bonds",
    "breaks", "captures", "confesses", "defeats", "defines", "escapes", "fears", "fights",
    "finds", "flees", "functions_as", "gives", "has_property", "hates", "helps", "hides",
    "hopes", "is_located", "is_made_of", "kills", "learns", "loses", "loves", "makes", "names",
    "observes", "other", "promises", "remembers", "reveals", "says", "stops", "suspects",
    "takes", "thinks", "threatens", "transforms", "travels", "uses", "wears", "wounds",
]

# Section folders that index pages link to.
SECTIONS = [
    "nav", "characters", "relationships", "entities", "claims", "mysteries", "episodes", "arcs",
    "references", "deferrals", "appearances", "reflections", "normalized", "cycleb",
]

# Entity kind in an id prefix, the front-matter list that holds it and its body heading.
ELEMENT_LISTS = {
    "characters": ("char", "登場人物"),
    "terminology": ("term", "用語"),
    "organizations": ("org", "組織"),
    "items": ("item", "物品"),
    "motifs": ("motif", "モチーフ"),
    "phrases": ("phrase", "キーフレーズ"),
    "relationships": ("rel", "関係性"),
}

# Template text that marks a page nobody has filled in yet.
PLACEHOLDERS = [
    "（ここにエピソードの要約を記述。人間が書くか、LLMで生成）",
    "（出来事1）",
    "（出来事2）",
    "（このエピソードに関する自由なメモ）",
    "（本文：人間が記述する部分。自動生成では変更されません。）",
]

# Labelled paragraphs of claim and mystery pages.
REVIEW_LABEL = "審査（LLM 代替）"
PAYOFF_LABEL = "回収示唆"

# The generated block whose text a name ledger must not touch.
LEDGER_BLOCK = "l2ref"

# Audit section of a normalized page.
AUDIT_RULE = "\n\n---\n\n"
AUDIT_TITLE = "## 名前正規化監査（L2 run "
AUDIT_TITLE_END = "）"
AUDIT_HEADER = "| 元名義 | 代表名 | 確度 | 置換件数 |\n|---|---|---|---|\n"
NOTE_TITLE = "\n\n注記（置換しない）:\n"
NOTE_PREFIX = "- 未置換（要検証）: 「"
NOTE_MIDDLE = "」→ "
NOTE_SUFFIX = "（要検証）"

# Chapter index page.
CLAIM_HEADING = "## アナロジークレーム（"
MYSTERY_HEADING = "## 伏線（"
REFERENCE_HEADING = "## 引喩先・外部参照（"
COUNT_END = " 件）"

# External reference page.
BACKLINK_HEADING = "## 本作からの参照 ("
BACKLINK_HEADING_END = " 件)"
BACKLINK_DASH = " — "
