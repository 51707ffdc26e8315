"""Patterns and word lists that documents are read by.

All are fixed values: they decide which lines count as markers, headings, list items or metadata.
ASCII classes only, so that every regular-expression engine reads them alike.
"""

LIST_ITEM = r"^\s*(?:[•\-*]|\(?\d{1,3}[.)]|\(?[ivxIVX]{1,8}[.)]|[A-Za-z][.)])\s+"
YEAR_START = r"^\d{4}\.\s+[A-Z]"
LIST_ITEM_BASE = r"^\s*(?:[•\-*]|\(?[0-9ivxIVX]+[.)])\s+"
ORDERED_ITEM = r"^\s*\(?[0-9ivxIVX]+[.)]\s+"
NUMBERED_PARAGRAPH = r"^\s*\d{1,3}[.)]\s+[A-Za-z]"
SHORT_NUMBER = r"^[\d./-]+[.)]?$"
SHORT_MARK = r"^(?:\(?[ivxIVX]+\)?|[a-zA-Z])(?:[.)])?$"
NUMERIC_CONTINUATION = r"^[\d./-]+[A-Za-z]?\.?$"
MULTILEVEL_START = r"^\(?\d+(?:\.\d+)*[.)]\s+"
CAPITAL_RUN = r"^[A-Z][A-Z\s,&/-]{3,}$"
NUMBERED_HEADING = r"^(?:\d+(?:\.\d+)*)\s+[A-Z][^.]{0,80}$"
LEGAL_LABEL = r"(?i)^(?:PETITIONER|RESPONDENT|BENCH|ACT|HEADNOTE|JUDGMENT|CITATION|DATE OF JUDGMENT)[:\-]?$"
HEADING_LABEL = r"(?i)^\s*(?:JUDGMENT|ORDER|CORAM|PRAYER|APPEARANCE)\s*$"
PAGE_NUMBER = r"(?i)^(?:page\s+)?\d+(?:\s+of\s+\d+)?$"
LINK = r"https?://"
CLOCK = r"\d{1,2}:\d{2}:\d{2}"
SIDE_LETTER = r"^[A-H]\.?$"
SENTENCE_END = r"[.?!:]$"
WATERMARK_WORD = r"(?i)(^|[^A-Za-z0-9_])(draft|confidential|sample|copy|duplicate|demo|preview|watermark)([^A-Za-z0-9_]|$)"
PAGE_MARKER = r"(?i)^Page\s+\d+\s+of\s+\d+$"
TRAILING_MARKER = r"(?i)^(?:(?:MAC\.APP|W\.P\.?|ARB\.P\.?|CS?\(?\w*\)?|CRL\.?|RFA?|FAO?|LPA?|OMP?|CW?|BAIL?)[\w\s\-\.\/]*\s{2,}\d+)$"
ANNOTATION = r"^\s*[$#~]"
BARE_CITATION = r"^\d{4}:\w+:\d+(?:-DB)?$"
NO_SPACE_AFTER = r"[(/₹$§]$"
NO_SPACE_BEFORE = r"^[),.;:%?!]"

CITATION = r"\d{4}:DHC:\d+(?:-DB)?"
TRAILING_CITATION = r"\s+\d{4}:\w+:\d+(?:-DB)?\s*$"
CASE_NUMBER = (
    r"(?i)^[+\*%]?\s*((?:W\.P\.\s*\((?:C|CRL)\)|CM\s*\(M\)|CS\s*\(OS\)|CS\s*\(COMM\)|CRL\.A\.|CRL\.M\.C\.|CRL\.REV\.P\.|RFA|RSA|FAO|ARB\.P\.|ARB\.A\.|O\.M\.P\.|"
    r"BAIL\s+APPLN\.|MAT\.APP\.|MAC\.APP\.|LPA|ITA|EFA|EX\.P\.|TEST\.CAS\.|CW|CONMT\.|CRL\.M\.A\.|W\.P\.Crl\.|C\.R\.P\.|CM\b)[\w\s\(\)\.\/\-\&,]+)"
)
JUDGMENT_DATES = (
    r"(?i)Judgment\s+(?:pronounced|delivered)\s+on\s*[:\-]\s*(.+?)$",
    r"(?i)Date\s+of\s+(?:decision|pronouncement)\s*[:\-]\s*(.+?)$",
    r"(?i)Decided\s+on\s*[:\-]\s*(.+?)$",
    r"(?i)Pronounced\s+on\s*[:\-]\s*(.+?)$",
    r"(?i)Date\s*[:\-]\s*(\d{1,2}[\.\-/]\d{1,2}[\.\-/]\d{4})(?:\s|$)",
)
RESERVED_DATES = (
    r"(?i)Judgment\s+Reserved\s+on\s*[:\-]\s*(.+?)$",
    r"(?i)Reserved\s+on\s*[:\-]\s*(.+?)$",
    r"(?i)Heard\s+on\s*[:\-]\s*(.+?)$",
)
APPELLANT = r"(?i)^([A-Z][A-Z0-9\s\.\,\&\/\(\)\-]+?)\s*\.{2,}\s*(?:Petitioner|Petitioners|Appellant|Appellants)\s*$"
RESPONDENT = r"(?i)^([A-Z][A-Z0-9\s\.\,\&\/\(\)\-]+?)\s*\.{2,}\s*(?:Respondent|Respondents|Opposite\s+Party|Opposite\s+Parties)\s*$"
PARTY_SEPARATORS = (" Vs ", " VS ", " vs ", " v. ", " V. ")
CONNECTED = r"(?i)connected\s+matters|batch\s+matters|tagged\s+matters|clubbed?\s+(?:with|matters)|analogous\s+matters"
CASE_COUNT = r"(?i)\b(?:CS\s*\(OS\)|CS\s*\(COMM\)|WP\(C\)|CRL|RFA|RSA|FAO|ARB|OMP|CW)[\s\-\.]*\d+[\s\/]\d+"
LEAD_CASE = r"(?i)((?:RFA|CS\s*\(OS\)|CS\s*\(COMM\)|WP\(C\)|CRL\.\w+|ARB\.\w+|OMP|FAO|RSA|LPA)[\s\-\.]*[\w\/\-\s]+?\d{4})"
CORAM = r"(?i)\bCORAM\s*:?"
JUDGMENT_HEADING = r"^(?:J\s*U\s*D\s*G\s*M\s*E\s*N\s*T|ORDER)$"
BENCH_STOP = r"(?i)^(?:THROUGH|FOR\s+THE|VERSUS|V\.S\.)"
BENCH_PREFIX = (
    r"(?i)^(?:HON'BLE MR\. JUSTICE|HON'BLE MR JUSTICE|HON'BLE MS\. JUSTICE|HON'BLE MS JUSTICE|HON'BLE MRS\. JUSTICE|HON'BLE MRS JUSTICE|HON'BLE DR\. JUSTICE|"
    r"HON'BLE DR JUSTICE|HON'BLE THE CHIEF JUSTICE|HON'BLE CHIEF JUSTICE|HON'BLE|MR\. JUSTICE|MR JUSTICE|MS\. JUSTICE|MS JUSTICE|JUSTICE|THE CHIEF JUSTICE)[\s\.]*"
)
JUDGE_NAME = r"(?i)^([A-Z][A-Z\s'\.]+),\s*J\.?\s*(?:\(ORAL\))?(?:\s*\[VIA\s+VIDEO\s+CONFERENCING\])?$"
ORAL = r"(?i)J\.\s*\(Oral\)|\(ORAL\)"
VIDEO = r"(?i)\bVIA\s+VIDEO\s+CONFERENCING\b"
REFERENCE = r"AIR\s+\d{4}\s+[A-Z]{2,6}\s+\d+|\(\d{4}\)\s+\d+\s+SCC\s+\d+|\(\d{4}\)\s+\d+\s+SCR\s+\d+|\[\d{4}\]\s+\d+\s+SCC\s+\d+|\d{4}:\w{2,8}:\d+(?:-DB)?"
ACT = r"\b([A-Z][a-zA-Z]{1,40}(?:\s+[A-Za-z\(\)]{1,40}){0,6}\s+(?:Act|Code|Rules|Regulations|Ordinance)(?:,\s*\d{4})?)\b"
ACT_NOISE = (
    r"(?i)(?:application\s+under|in\s+accordance|pursuant\s+to|provisions?\s+of\s+the|under\s+the\s+said|terms\s+of\s+the|filed\s+an?\s+|considering\s+an?\s+|submitted\s+that|"
    r"present\s+(?:case|petition)|section\s+\d+\s+of\s+the|order\s+xi|order\s+vii|^the\s+said|^an?\s+application|^while\s+|^further\s+|^learned\s+|^on\s+the\s+other)"
)
#: First words that no act begins with, a set.
ACT_STOP_WORDS = [
    "a", "an", "any", "as", "at", "be", "been", "being", "by", "considering", "filed", "for", "further", "had", "has", "have", "in",
    "is", "its", "learned", "no", "not", "of", "on", "order", "present", "said", "submitted", "such", "that", "the", "this", "to", "under", "was", "while",
]
ADVOCATE_SIDE = r"(?i)\s+for\s+(?:respondent|petitioner|appellant|opposite\s+party)\s*[\w\s\.]*"
ADVOCATE_TITLE = r"(?i)\b(?:Senior\s+Advocate|Sr\.?\s*Adv\.?|Advocate|Adv\.?)\b"
ADVOCATE_NAME = r"^(?:Mr\.|Ms\.|Mrs\.|Dr\.)\s*\S"
THROUGH = r"(?is)Through\s*:\s*(.+?)(?=(?:Through\s*:|versus|\.{3,}|CORAM\b|$))"

ZONES = (  # in order, the first that matches; on upper-case text but where said
    ("header", r"HIGH COURT|SUPREME COURT"),
    ("coram_label", r"^CORAM\s*:?"),
    ("coram_judge", r"^HON'?BLE|^JUSTICE\b|^MR\.\s*JUSTICE|^MS\.\s*JUSTICE"),
    ("appearances", r"^(?:THROUGH\s*:|FOR\s+THE\s+(?:PETITIONER|RESPONDENT|APPELLANT)|APPEARANCES?)"),
    ("order_heading", r"^(?:ORDER|JUDGMENT|J\s*U\s*D\s*G\s*M\s*E\s*N\s*T)\s*$"),
    ("para", r"^\d+[.)]\s+\S"),
    ("judge_name", r"^[A-Z][A-Z\s'\.]+,\s*J\.?\s*(?:\(ORAL\))?$"),
    ("header", r"^(?:DATE\s+OF\s+DECISION|PRONOUNCED\s+ON|DECIDED\s+ON)"),
)
CONTINUATION_WORDS = ("of", "and", "or", "to", "from", "in", "on", "at", "for", "by", "with", "under", "into", "upon", "vs.", "v.", "no.", "nos.", "section", "sections")

#: Code points that browsers do not show as a letter: ranges, ends included.
#: Ranges of illegal code points in ascending order, those that adjoin written as one.
ILLEGAL_RANGES = (
    (0x00, 0x1F), (0x7F, 0xA0), (0xAD, 0xAD), (0x300, 0x36F), (0x61C, 0x61C), (0x900, 0x97F), (0xA00, 0xA7F), (0x1361, 0x1361), (0x1AB0, 0x1AFF), (0x1DC0, 0x1DFF), (0x200B, 0x200F),
    (0x2028, 0x202E), (0x2066, 0x2069), (0x20D0, 0x20FF), (0xD800, 0xDFFF), (0xFE20, 0xFE2F), (0xFEFF, 0xFEFF), (0xFFFC, 0xFFFC), (0xFFFE, 0xFFFF),
)
