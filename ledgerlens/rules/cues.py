"""Cue, demotion and heading rules of the window operators."""

# Cue patterns, tried in this order.
STRICT = (
    r"competitors\s+include", r"principal\s+competitors", r"primary\s+competitors", r"we\s+compete\s+with", r"we\s+face\s+competition\s+from", r"face\s+competition\s+from",
    r"companies\s+that\s+have\s+introduced\s+(?:products?|services?|technologies?)\s+include", r"the\s+following\s+companies\s+(?:are|include|compete)",
    r"our\s+(?:principal|primary|major|key|direct)\s+competitors", r"competition\s+from\s+(?:companies\s+such\s+as|companies\s+including)", r"major\s+competitors\s+include",
    r"key\s+competitors\s+include", r"direct\s+competitors\s+include", r"competition\s+comes\s+from", r"compete\s+against", r"competing\s+with", r"compete\s+directly\s+with",
    r"significant\s+competitors", r"competitive\s+(?:threat|threats)\s+from", r"compete\s+in\s+(?:the\s+)?(?:same|these|our)\s+markets?\s+with",
)
CONTEXTUAL = (
    r"competition\s+from", r"main\s+competitiors", r"our\s+competitors", r"competition\s+in\s+the", r"the\s+competition\s+in\s+the", r"highly\s+competitive", r"intensely\s+competitive",
    r"intense\s+competition", r"pricing\s+pressure", r"price\s+pressure", r"market\s+share", r"\bcompetitors?\b", r"\bcompete\b", r"\brivals?\b",
    r"competitive\s+(?:environment|landscape|conditions|pressures?|dynamics)", r"competition\s+in\s+(?:our|the)", r"compete\s+on\s+(?:the\s+basis|price|quality|performance|features?)",
)
IMPLICIT = (
    r"installed\s+base", r"technical\s+resources?", r"marketing\s+resources?", r"distribution\s+(?:channel|network|capabilities?)", r"switching\s+costs?", r"barriers?\s+to\s+entry",
    r"wallet\s+share", r"competitive\s+advantage", r"competitive\s+position", r"ability\s+to\s+compete", r"effectively\s+compete",
)
# Demotions as (pattern, reason); only GENERIC_ADVANTAGE doesn't suppress.
GENERIC_ADVANTAGE = "generic_competitive_advantage"
DEMOTIONS = (
    (r"customers?\s+include", "customer_example"), (r"clients?\s+include", "customer_example"), (r"examples?\s+include", "example_language"), (r"such\s+as\b", "negative_context"),
    (r"for\s+example", "example_language"), (r"services?\s+(?:such\s+as|including|like)", "negative_context"), (r"offered\s+by", "negative_context"), (r"used\s+by", "negative_context"),
    (r"through\s+(?:brands?|companies|firms)\s+including", "negative_context"), (r"third[- ]party\s+(?:services?|providers?|platforms?)", "product_catalog"),
    (r"partners?\s+include", "partner_vendor_mention"), (r"suppliers?\s+include", "partner_vendor_mention"), (r"vendors?\s+include", "partner_vendor_mention"),
    (r"regulatory\s+(?:requirements?|environment|approval)", "regulation_compliance"), (r"patent(s)?\s+(?:protection|portfolio|litigation)", "regulation_compliance"),
    (r"compliance\s+with", "regulation_compliance"), (r"competitive\s+advantage\s+(?:that|we|our)", GENERIC_ADVANTAGE), (r"our\s+competitive\s+position", GENERIC_ADVANTAGE),
    (r"product\s+(?:lines?|portfolio|offerings?)\s+(?:include|such as)", "product_catalog"), (r"platform(s)?\s+(?:include|such as|offered by)", "product_catalog"),
)
# Heading patterns by category, and those that allow a fallback window.
HEADINGS = (
    ("competition_heading", (r"^\s*(item\s*1\s*[.\-–—:]?\s*)?(our\s+)?competition\s*$", r"^\s*competitive\s+(?:environment|landscape|conditions|overview|dynamics)\s*$", r"^\s*competitive\s+conditions\s*$", r"^\s*market\s+competition\s*$")),
    ("product_service_heading", (r"^\s*(?:our\s+)?(?:products?\s*(?:and\s+services?)?|services?\s*(?:and\s+products?)?)\s*$", r"^\s*(?:product|service)\s+overview\s*$", r"^\s*(?:product|service)\s+(?:lines?|portfolio|offerings?)\s*$", r"^\s*(?:solutions?|platform|technology)\s+overview\s*$")),
    ("geography_channel_heading", (r"^\s*(?:geographic|geography|international|global)\s+(?:overview|presence|reach|distribution|operations?)\s*$", r"^\s*(?:sales\s+)?channels?\s*$", r"^\s*distribution\s*$", r"^\s*international\s+(?:operations?|markets?)\s*$")),
    ("customer_heading", (r"^\s*(?:our\s+)?customers?\s*$", r"^\s*(?:customer|client)\s+(?:base|segments?|overview)\s*$", r"^\s*(?:end[\s-]?users?|use\s+cases?)\s*$", r"^\s*(?:target\s+market|markets\s+served)\s*$")),
)
FALLBACK_HEADINGS = (r"\bcompetition\b", r"\bcompetitive\b", r"\bcompetitive\s+landscape\b", r"\bmarket\s+competition\b", r"\bcompetitive\s+conditions\b")
# Keywords of the profile hint.
GEOGRAPHY_WORDS = r"\b(?:united\s+states|u\.s\.|europe|asia|latin\s+america|canada|china|india|japan|global|international|domestic|region|country|countries|worldwide|abroad)\b"
CUSTOMER_WORDS = r"\b(?:customers?|clients?|end[\s-]?users?|buyers?|enterprises?|consumers?|subscribers?)\b"
PRODUCT_WORDS = r"\b(?:products?|services?|solutions?|platforms?|software|hardware|offerings?|portfolio)\b"
SEGMENT_WORDS = r"\b(?:segments?|verticals?|divisions?|business\s+units?|subsidiaries?|brands?)\b"
# Abbreviations whose full stop doesn't end a sentence.
ABBREVIATIONS = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Sr", "Jr", "vs", "etc", "Inc", "Corp", "Ltd", "Co", "St", "Ave", "Blvd", "approx", "est", "fig", "no", "vol")
DOTTED_ABBREVIATIONS = (("e", "g"), ("i", "e"), ("U", "S"), ("U", "K"), ("p", "m"), ("a", "m"))
# Numbers of the window operator.
LOOKBACK, NEARBY, REACH, NEAR_DUPLICATE, HEADING_LENGTH = 20, 2, 2, 0.75, 120
#: A text without any of these words, in lower case, matches no cue pattern; one without the first matches no competition heading.
CUE_WORDS = ("compet", "compan", "pric", "market", "rival", "installed", "technical", "distribution", "switching", "barrier", "wallet")
