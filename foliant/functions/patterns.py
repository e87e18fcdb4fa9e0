"""Patterns by which sections, years and identities are told in report texts."""

from __future__ import annotations

# Headings of the section sought.
_MD = r"Manage(?:ment|rial)(?:['’]?s)?"
_AND = r"(?:and|&|and/or|cum)"
HEADING = rf"{_MD}\s*[-–—:]?\s*Discussions?\s*{_AND}?\s*Analysis(?:\s*(?:Report|Statement|Section))?"
ACRONYM = r"\bMD\s*&\s*A\b|\bMDA\b"
COMBINED = rf"(?:Directors|Board)['’]?s?\s+Report\s+{_AND}\s+{_MD}\s*Discussions?"
# Headings that end it.
TERMINATORS = (
    r"Report\s+on\s+Corporate\s+Governance",
    r"Corporate\s+Governance\s+Report",
    r"Business\s+Responsibility\s*(?:and\s+Sustainability)?\s*Report",
    r"\bBRSR\s+Report\b",
    r"Independent\s+Auditor(?:'s|s'|’s|s’|s)?\s+Report",
    r"Auditor(?:'s|s'|’s|s’|s)?\s+Report",
    r"To\s+the\s+Members\s+of\b",
    r"(?:Standalone|Consolidated)\s+Financial\s+Statements?",
    r"Balance\s+Sheet\s+as\s+at",
    r"Statement\s+of\s+Profit\s+(?:and|&)\s+Loss",
    r"Notice\s+of\s+(?:the\s+)?(?:\d+\w*\s+)?Annual\s+General\s+Meeting",
    r"Notice\s+of\s+(?:the\s+)?AGM\b",
    r"Directors(?:'|’)?\s+Report",
    r"Board(?:'s|’s)?\s+Report",
    r"\bAnnexure\s+(?:[IVXLCDM]+|\d+)\b",
    r"Annexure\s+[A-Z0-9]+\s+to\s+the\s+(?:Board|Directors)",
    r"Secretarial\s+Audit\s+Report",
    r"Shareholder(?:s)?\s+Information",
    r"General\s+Shareholder\s+Information",
    r"Report\s+on\s+the\s+(?:Standalone\s+|Consolidated\s+)?Financial\s+Statements?",
    r"Consolidated\s+Accounts",
    r"Ten\s+Years?(?:'s)?\s+(?:at\s+a\s+glance|Financial\s+Highlights|Summary)",
    r"Ten\s+Year\s+Financial\s+Highlights",
)
TERMINATOR = "|".join(f"(?:{p})" for p in TERMINATORS)
# Sentences that only point to the section; of the second group those that say "below" do not count.
POINTERS = (
    r"\b(?:is|are)\s+(?:enclosed|attached|annexed)\b",
    r"\bforms?\s+part\s+of\s+(?:this|the)\s+(?:Integrated\s+)?(?:Annual\s+)?Report\b",
    r"\b(?:enclosed|attached|annexed)\s+(?:herewith|hereto|as\s+Annexure|at\s+Annexure)\b",
    r"\bseparately\s+(?:enclosed|attached|annexed|presented|given)\b",
    r"\b(?:presented|included|given)\s+in\s+a\s+separate\s+section\b",
    r"\ba\s+separate\s+section\s+on\b",
)
POINTER = "|".join(f"(?:{p})" for p in POINTERS)
POINTER_GIVEN = r"\b(?:is|are)\s+(?:given|presented|provided)\b"
POINTER_BELOW = POINTER_GIVEN + r"\s*[:–—-]*\s*(?:below|hereunder|as\s+under|as\s+follows)\b"
# Sub-headings of the section's body.
BODY_CUES = (
    r"Industry\s+Structure\s+(?:and|&)\s+Developments?",
    r"Opportunities\s+(?:and|&)\s+Threats",
    r"(?:Segment|Product)[\s\-–]*wise\s+(?:or\s+product[\s\-]*wise\s+)?Performance",
    r"\bOutlook\b",
    r"Risks?\s+(?:and|&)\s+Concerns?",
    r"Internal\s+Control\s+Systems?\s+(?:and|&)\s+(?:their\s+)?Adequacy",
    r"Discussion\s+on\s+Financial\s+Performance",
    r"Material\s+Developments?\s+in\s+Human\s+Resources",
    r"Human\s+Resources?\s*/?\s*Industrial\s+Relations",
    r"Key\s+Financial\s+Ratios",
    r"Details\s+of\s+Significant\s+Changes.{0,40}Ratios",
    r"Return\s+on\s+Net\s+Worth",
    r"Cautionary\s+Statement",
    r"Debtors?\s+Turnover",
    r"Interest\s+Coverage\s+Ratio",
    r"Operating\s+Profit\s+Margin",
)
# Ratios that must be disclosed.
RATIOS = (
    r"\bdebtors?\s+turnover(?:\s+ratio)?\b",
    r"\binventor(?:y|ies)\s+turnover(?:\s+ratio)?\b",
    r"\binterest\s+coverage(?:\s+ratio)?\b",
    r"\bcurrent\s+ratio\b",
    r"\bdebt\s*(?:[-/]|to|\s+)\s*equity(?:\s+ratio)?\b",
    r"\boperating\s+profit\s+margin(?:\s*\(?%\)?|\s+ratio)?\b",
    r"\bnet\s+profit\s+margin(?:\s*\(?%\)?|\s+ratio)?\b",
    r"\breturn\s+on\s+net\s*worth\b",
)
# Signs of the regulatory era.
ERA_SIGNS = {
    "brsr": r"business\s+responsibility\s+and\s+sustainability",
    "br_report": r"business\s+responsibility\s+report",
    "ind_as": r"\bind\s*as\b",
    "companies_act_2013": r"companies act,? 2013",
    "csr": r"corporate\s+social\s+responsibility",
}
# Passages that belong to other sections, and their tags.
LEAKS = (
    (r"we\s+have\s+audited\s+the\s+accompanying", "auditor_report_leak"),
    (r"basis\s+for\s+opinion", "auditor_report_leak"),
    (r"notice\s+is\s+hereby\s+given\s+that", "agm_notice_leak"),
    (r"notes\s+forming\s+part\s+of\s+the\s+financial\s+statements", "notes_leak"),
    (r"composition\s+of\s+the\s+board\s+of\s+directors", "cg_report_leak"),
)
# How a section of this kind ends.
CAUTIONARY = (
    r"forward[\s-]?looking|cautionary\s+statement|\bdisclaimer\b|undue\s+reliance|\bcaution(?:s|ed|ary)?\b"
    r"|actual\s+(?:results?|outcomes?)|statements?\s+(?:are\s+)?(?:based\s+on|subject\s+to|forward)"
    r"|beyond\s+the\s+(?:control|management)|risks?,?\s+(?:and\s+)?concerns?"
)
# Programs that re-lay the text of a file.
REPROCESSORS = ("ilovepdf", "smallpdf", "pdf24", "sejda", "soda pdf", "online2pdf", "pdfescape", "pdf compressor", "compress pdf", "nitro")
# Families of year mentions.
FY_RANGE = r"\b(?:F\.?\s?Y\.?|FY|Financial\s+Year|Fiscal\s+Year|fiscal)?\s*(19[89]\d|20\d{2})\s*[-–—/]\s*(\d{2}|\d{4})\b"
FY_SINGLE = r"\bF\.?\s?Y\.?\s?(19[89]\d|20\d{2})\b"
_MONTH = r"(March|Mar|June|Jun|September|Sep|December|Dec)\s*,?\s*(19[89]\d|20\d{2})"
YEAR_ENDED = r"(?:year|period)\s+ended\s+(?:on\s+)?(?:31\s*(?:st)?|30\s*(?:th)?)?\s*(?:st|nd|rd|th)?\s*(?:day\s+of\s+)?" + _MONTH
AS_AT = r"as\s+at\s+(?:31\s*(?:st)?|30\s*(?:th)?)\s*(?:st|nd|rd|th)?\s*" + _MONTH
# Lines of a contents page, printed page numbers, security codes and where they stand.
CONTENTS_LINE = r"^([A-Za-z][^\d]{2,88}?)[^A-Za-z0-9]{2,}(\d{1,4})\s*$"
FOLIO_LINE = r"^\|?\s*(\d{1,4})\s*\|?$"
ISIN = r"\bIN[EF9CD][0-9A-Z]{8}[0-9]\b"
ISIN_PLACES = (
    "general shareholder information", "shareholder information", "shareholders information", "corporate governance",
    "depository system", "corporate information", "company information", "statutory report",
)
TITLE_SMALL = (
    "and", "or", "the", "of", "in", "on", "at", "to", "for", "with", "a", "an", "by", "as", "&", "from", "into", "through",
    "over", "st", "nd", "rd", "th",
)
# Parameters of a locator that are secrets.
SECRET_PARAMETER = "(token|auth|key|secret|sig|pass|cred|bearer|session)|^pwd$"
