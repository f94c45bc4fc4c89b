"""The keep, drop and review policy of organisation mentions, and the label rules.

Which exact strings are dropped is a parameter of the policy; DROP is its default.
"""

# Exact strings, compared in lower case.
KEEP = ("x", "abi", "aws")
DROP = (
    "company", "bank", "charter", "board", "committee", "registrant", "filing", "shareholder", "shareholders", "stockholder", "stockholders", "llc", "llp", "l.l.c.",
    "l.p.", "plc", "p.c.", "p.l.l.c.", "inc", "inc.", "corp", "corp.", "co.", "co", "ltd", "ltd.", "corporation", "incorporated", "limited", "nv", "n.v.", "s.a.", "ag",
    "kgaa", "sa", "internet", "european", "north american", "non-north american", "asian", "latin american", "middle eastern", "african", "scandinavian", "oceanian",
    "in", "chinese", "canadian", "spanish", "the internet", "fintech", "martech", "bdc", "hotel", "residential", "learners", "type", "lng", "eds", "operations",
    "functional", "global technology", "research and development", "human capital", "401k", "401(k)", "use authorization", "pneumatic comfort technologies", "acoustics",
    "south korean company", "commercial automobile program", "car's commercial automobile program", "the business combination", "business combination",
    "initial business combination", "initial public offering", "the initial public offering", "private placement", "private placement warrants", "public offering",
    "comprehensive plan for add", "supply chain services", "performance services", "com", "net", "org", "fda", "usda", "fha", "national cancer institute",
    "the national cancer institute", "federal reserve", "the federal reserve", "federal reserve bank", "the federal reserve bank", "u.s. international trade commission",
    "the u.s. international trade commission", "usitc", "european commission", "the european commission", "u.s. department of energy", "u.s. department of treasury",
    "the u.s. department of treasury", "u.s. navy", "u.s. government", "the u.s. government", "gse", "gses", "sec", "ftc", "irs", "epa", "osha", "nih", "cdc", "hhs",
    "cms", "ofac", "cftc", "finra", "occ", "fdic", "fcc", "fema", "dea", "atf", "fbi", "nhtsa", "uspto", "doj", "treasury", "the treasury", "medicare", "medicaid",
    "congress", "1940 act", "orange book", "the orange book", "covid-19", "lgbtq", "anda", "nda", "snda", "bla", "maa", "phase 1", "phase 2", "phase 3", "phase 1b",
    "phase 2b", "phase 3b", "cdk", "cdk9", "cd", "aml", "mll", "npm1", "pah", "ms", "btk", "pcnsl", "pcns", "bcl", "fl", "ce", "sars", "cov", "ec", "meni", "ccenture",
    "ffymetrix, inc", "ffymetrix, inc.", "ica biosystems, inc", "ica biosystems, inc.", "eophysical technologies", "uvasive, inc", "uvasive, inc.",
    "yndax pharmaceuticals, inc.", "yndax pharmaceuticals, inc", "ioenergy devco", "rbella mutual insurance company", "be", "cton dickinson", "rid dynamics", "knowb",
    "cy", "bersecurity", "sanita", "ware", "ava", "ility, llc", "fosys", "eistlich pharma ag", "ualtrics international inc", "ioventus inc", "rimient", "st",
    "rata oncology, inc", "pre", "therapeutics", "pt", "pa",
)
REVIEW = ("va", "car", "ai", "it", "hc", "sg", "lyr", "am", "dhcm", "dlf", "ge")
# Patterns in the order in which they are tried; (?i) where case doesn't count.
DROP_PATTERNS = (
    (r"^\W+$", "punctuation_only"),
    (r"^(?:[\*_]*)?(?:\(\s*[+\-−]?\d[\d\s,\.\:/%_]*(?:[eE][+\-]?\d+)?\s*\)|[+\-−]?\d[\d\s,\.\:/%_]*(?:[eE][+\-]?\d+)?)[\*_]*$", "pure_numeric"),
    (r"(?i)^phase\s*\d+[a-z]?\b", "clinical_phase_prefix"), (r"(?i)^phase\s+[ivx]+\b", "clinical_phase_roman"), (r"(?i)^.*\bdose\s+escalation\b", "clinical_dose_escalation"),
    (r"(?i)^early[\s-]stage\s+clinical\b", "clinical_early_stage"), (r"(?i)\bclinical\s+trial\b", "clinical_trial_phrase"), (r"(?i)^u\.s\.\s+department\s+of\s+", "us_department_of"),
    (r"(?i)^the\s+u\.s\.\s+department\s+of\s+", "the_us_department_of"), (r"(?i)\sact$", "statute_act_suffix"), (r"(?i)^stage\s*\d+[a-z]?\b", "clinical_stage"),
    (r"(?i)^cohort\s+[a-z0-9\-]+$", "cohort_label"), (r"(?i)^part\s+(\d+[a-z]?|[a-z]\d*)$", "trial_part"), (r"(?i)\bfda\s+approval\b", "fda_approval_phrase"),
    (r"(?i)^inhibitors?$", "inhibitor_word"), (r"(?i)^patients?$", "patients_word"), (r"(?i)\bgeneric\s+(?:drug|product|version)\b", "generic_drug_phrase"),
    (r"(?i)\bmarket\s+exclusivity\b", "market_exclusivity_phrase"),
)
# Legal endings of a company's fingerprint (dots are gone by then) and of an owner's name.
LEGAL_TAIL = ("inc", "corp", "corporation", "llc", "ltd", "lp", "llp", "plc", "co", "company", "limited", "sa", "ag", "nv")
LEGAL_SUFFIXES = ("inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "llc", "plc", "ag", "sa", "nv", "lp", "llp", "holdings", "holding", "group")
# Curly quotes and their ASCII forms, position by position; what is stripped at both ends; labels.
CURLY, STRAIGHT = "‘’‚‛′ʼ“”„«»", "''''''" + '"""""'
STRIPPED = " \t\r\n\"'•‣◦⁃∙*▪▫·․∘–—"
TLDS = ("com", "net", "org", "io")
ROLES = (("COMPANY", "explicit_company_candidate"), ("PRODUCT_BRAND", "explicit_support_via_product"), ("GENERIC_PRODUCT_CATEGORY", "implicit_only"))
LABELS = ("COMPANY", "PRODUCT_BRAND", "GENERIC_PRODUCT_CATEGORY", "Non coporate AGENCY", "OTHER")
SEPARATOR = " ; "
# Competitor phrases.
PHRASES = (
    r"(?:competitors?|companies?|providers?|platforms?|services?|marketplaces?|players?|vendors?)\s+(?:include|consist of|comprise|such as|like)\s+([^.!?;,\n]{15,300})(?=[.!?;,\n]|$)",
    r"(?:we\s+)?(?:compete|competing|competing in|compete with)\s+(?:with\s+)?([^.!?;,\n]{15,300})(?=[.!?;,\n]|$)",
    r"(?:our\s+)?(?:(?:major|primary|principal|key|direct|significant)\s+)?competitors?(?:\s+in\s+[^.!?;,\n]{1,120})?\s+(?:are|were|remain|include)\s+([^.!?;,\n]{15,300})(?=[.!?;,\n]|$)",
    r"([^.!?;,\n]{15,300})\s+(?:are|were|remain)\s+(?:our\s+)?(?:(?:major|primary|principal|key|direct|significant)\s+)?competitors?\b(?=[.!?;,\n]|$)",
)
#: What every pattern of PHRASES but the first needs, and marks that no match of any of them holds.
PHRASE_STEM, PHRASE_ENDS = "compet", "[.!?;,]"
# Characters without width, which offsets skip; tickers; attribute labels by falling precedence; types of attributes.
ZERO_WIDTH = "\u200b\u200c\u200d\u2060\u2061\u2062\u2063\ufeff\u00ad"
TICKER = r"^[A-Z]{1,5}$|^[A-Z]{1,5}\.[A-Z]$"
ATTRIBUTES = ("LOC", "PRODUCT")
TYPE_OF_ATTRIBUTE = (("LOC", "REGION"), ("PRODUCT", "ComputingProduct"))
# Columns of the cleaned prefilter table, and names under which counts and lists come in, first to last.
CLEAN_COLUMNS = (
    "window_id", "source_company", "source_cik", "submitter_cik", "filing_year", "section", "cue_phrase", "cue_group", "trigger_sentence", "window_text", "org_mentions_union_count", "org_mentions_union",
    "mention_types_union_filtered", "org_mentions_union_filtered", "org_mentions_removed_count", "org_mentions_removed_count_by_type",
)
UNION_COUNT_NAMES = ("org_mentions_union_count", "org_mention_count_union", "org_mentions_count", "org_mentions_raw_count")
UNION_NAMES = ("org_mentions_union", "org_mentions_union_raw")
