"""Vocabularies and display texts.

FIXED VALUES: these must equal the originals for identical output (codes,
order, labels, markers, month names, default texts, limits).
"""

from __future__ import annotations

# --- fixed values: severities, in sort order (rank 0 first) ----------------
SEVERITIES = ["critical", "important", "notable", "ignore"]
# original French codes, same order
SEVERITIES_FR = ["critique", "important", "interessant", "ignore"]
DEFAULT_SEVERITY = "ignore"
PRIORITY_SEVERITIES = ["critical", "important"]

# --- fixed values: categories, in display order ------------------------------
CATEGORIES = ["security", "backend", "frontend", "devops", "ai", "general"]
CATEGORIES_FR = ["securite", "backend", "frontend", "devops", "ia", "general"]
DEFAULT_CATEGORY = "general"

# --- fixed values: display labels of categories (display order) --------------
CATEGORY_LABELS = {
    "security": "Sécurité",
    "backend": "Backend",
    "frontend": "Frontend",
    "devops": "DevOps",
    "ai": "IA",
    "general": "Général",
}

# --- fixed values: category markers (same in report and message) -------------
CATEGORY_MARKERS = {
    "security": "🔐",
    "backend": "⚙️",
    "frontend": "🎨",
    "devops": "🚀",
    "ai": "🤖",
    "general": "📚",
}
DEFAULT_CATEGORY_MARKER = "📚"

# --- fixed values: severity markers, report file -----------------------------
REPORT_SEVERITY_MARKERS = {
    "critical": "🚨",
    "important": "⚠️",
    "notable": "💡",
    "ignore": "⏭️",
}
REPORT_DEFAULT_SEVERITY_MARKER = "•"

# --- fixed values: severity markers, chat message ----------------------------
MESSAGE_SEVERITY_MARKERS = {
    "critical": "🔴",
    "important": "🟠",
    "notable": "🟡",
    "ignore": "⚪",
}
MESSAGE_DEFAULT_SEVERITY_MARKER = "⚪"

# --- fixed values: French month names, January first -------------------------
MONTHS_FR = ["janvier", "février", "mars", "avril", "mai", "juin",
             "juillet", "août", "septembre", "octobre", "novembre", "décembre"]

# --- fixed values: limits ----------------------------------------------------
SUMMARY_MAX_CHARS = 500
TOP_PRIORITY_CAP = 3
FALLBACK_ITEMS = 8
RECAP_TOP = 3
TAKEAWAYS_MAX = 3
RECENCY_HOURS = 24
LEDGER_RETENTION_DAYS = 90
LIMIT_TITLE = 256
LIMIT_FIELD = 1024
LIMIT_DESCRIPTION = 4096
LIMIT_TOTAL = 6000
# quotas written in the scoring rubric (asked of the model, optional here)
QUOTA_TOTAL = 6
QUOTA_PRIORITY = 3
QUOTA_NOTABLE = 3
QUOTA_PER_PRIORITY_SEVERITY = 2

# --- fixed values: fallback texts and defaults -------------------------------
FALLBACK_SEVERITY = "notable"
FALLBACK_SCORE = 5
FALLBACK_REASON = "Classement IA indisponible — article brut."
DIGEST_EMPTY_SUMMARY = "Aucun article à analyser aujourd'hui."
DIGEST_DEFAULT_SUMMARY = "Synthèse indisponible."
DIGEST_FALLBACK_SUMMARY = ("Le classement automatique n'a pas pu être généré ; "
                           "voici les articles bruts du jour.")
RECAP_EMPTY_TRENDS = "Aucun article retenu cette semaine."
RECAP_DEFAULT_TRENDS = "Synthèse hebdomadaire indisponible."
RECAP_FALLBACK_TRENDS = ("Synthèse IA indisponible cette semaine. Top 3 calculé par "
                         "tri sur criticité puis score.")

# --- fixed values: report texts ----------------------------------------------
REPORT_NO_TOP = "_Pas d'article phare cette semaine._"
REPORT_NO_TRENDS = "_Aucune tendance identifiée._"
REPORT_NO_TAKEAWAYS = "_Pas de takeaway cette semaine._"
MESSAGE_NO_PRIORITY = "_Aucune priorité aujourd'hui._"
MESSAGE_NO_OTHER = "_Aucun autre article retenu._"
MESSAGE_NO_SPLIT = "_Aucune répartition disponible._"

# --- fixed values: message colours -------------------------------------------
COLOR_BLUE = 0x3498DB
COLOR_RED = 0xE74C3C
COLOR_GREEN = 0x2ECC71
COLOR_ORANGE = 0xE67E22
COLOR_VIOLET = 0x9B59B6
COLOR_GREY = 0x95A5A6

# Footer of the daily message. The original names its own product here; we
# keep the text a parameter with a neutral default (documented deviation).
DEFAULT_FOOTER = "Généré automatiquement"


def severity_rank_sql(col: str) -> str:
    """SQL CASE giving the sort rank of a severity; unknown sorts last (3)."""
    whens = " ".join(f"when '{s}' then {i}" for i, s in enumerate(SEVERITIES))
    return f"(case {col} {whens} else 3 end)"


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)
