"""Word lists, patterns and tables whose content results depend on."""

from __future__ import annotations

#: White space as Python's str.split() sees it, as a list of characters and as a regex class.
BLANKS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
#: Line ends as str.splitlines() sees them.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"

MIN_WORDS = 40
ENGLISH_SHARE = 0.22
ENGLISH = [
    "the", "and", "of", "to", "in", "for", "is", "are", "be", "on", "or", "with",
    "as", "at", "an", "will", "by", "this", "that", "from", "you", "your", "their",
    "a", "not", "have", "has", "must", "may", "can", "which", "who", "students",
    "applications", "application", "deadline", "programme", "program", "research",
]
#: Lines that match one of these are page furniture; the second needs only their beginning.
NOISE = [
    r"^\s*(share (this|on)|tweet|like this:?|related (posts|articles?)|you may also like|leave a (reply|comment)|click to share|whatsapp|telegram|facebook|x\b|linkedin|pinterest|email|print|more)[:!.]?\s*$",
    r"^\s*(subscribe|sign up|follow us|join our|download now|we use cookies?|cookie (policy|notice)|accept all|privacy policy|terms of (use|service)|all rights reserved|copyright ©?).*$",
    r"^\s*\d+\s*shares?\s*$",
    r"^\s*(advertisement|sponsored|recommended for you)\s*$",
]
NOISE_LINE = "(?i)" + "|".join(f"(?:{p})" for p in NOISE)

TITLE_THRESHOLD = 0.90
TITLE_NOISE = r"\b(scholarship|scholarships|application|apply|now|open|2026|2025|fully funded)\b"

CATEGORIES = ["scholarships", "fellowships", "phd", "postdoc", "grants", "internships", "competitions", "awards", "conferences", "workshops", "exchange_programs", "miscellaneous"]
ALIASES = {
    "masters": "scholarships", "undergraduate": "scholarships", "bursaries": "scholarships", "research_grants": "grants",
    "doctoral_grants": "grants", "travel_grants": "grants", "summer_schools": "workshops", "trainings": "workshops",
    "seminars": "workshops", "symposia": "conferences", "call_for_papers": "conferences", "prizes": "awards", "travel_awards": "awards",
}
TITLE_SIGNALS = {
    "scholarship": "scholarships", "fellowship": "fellowships", "internship": "internships", "competition": "competitions",
    "prize": "competitions", "award": "awards", "conference": "conferences", "summit": "conferences", "workshop": "workshops",
    "training": "workshops", "exchange": "exchange_programs", "grant": "grants", "phd": "phd", "doctoral": "phd",
    "postdoc": "postdoc", "postdoctoral": "postdoc", "masters": "masters", "summer school": "summer_schools",
}
AUDIT_SIGNALS = {
    "scholarships": ["scholarship", "bursary", "stipend"], "fellowships": ["fellowship"], "phd": ["phd", "doctoral"],
    "postdoc": ["postdoc", "postdoctoral"], "grants": ["grant"], "internships": ["internship"],
    "competitions": ["competition", "challenge", "hackathon"], "awards": ["award", "prize"],
    "conferences": ["conference", "summit", "symposium"], "workshops": ["workshop", "summer school", "training"],
    "exchange_programs": ["exchange"],
}
PILOT_SIGNALS = {
    "scholarships": ["scholarship", "bursary"], "fellowships": ["fellowship"], "phd": ["phd", "doctoral"], "postdoc": ["postdoc"],
    "grants": ["grant"], "internships": ["internship"], "competitions": ["competition", "hackathon"], "awards": ["award", "prize"],
    "conferences": ["conference", "summit"], "workshops": ["workshop", "summer school", "training"], "exchange_programs": ["exchange"],
}
AUDIT_SAMPLE = 12
AUDIT_OVERSAMPLE = {"fellowships": 20, "phd": 20, "postdoc": 20, "grants": 20, "awards": 20, "competitions": 20}

SEED = 42
UNSEEN_FRACTION = 0.15
#: What the summarizing endpoint asks for; the text of the posting follows.
SERVICE_PROMPT = (
    "Summarize the following opportunity posting as high-signal intelligence.\nUse sections MANDATORY / RESTRICTIONS / IMPORTANT / PREFERRED / SUMMARY "
    "(omit empty sections), at most 150 words, and never invent information.\n\nOPPORTUNITY POSTING:\n"
)
SUMMARY_SECTIONS = ["DEADLINE", "MANDATORY", "RESTRICTIONS", "TARGET GROUP", "FUNDING", "APPLICATION", "SUMMARY"]
#: The UUID namespace of record ids, in hexadecimal.
RECORD_NAMESPACE = "f99a8ffcecd9556c85b5a8ae8acd0a3b"
RAW_TEXT_LIMIT = 400_000
NOUL_NEIGHBOURS = {
    "scholarships": ["fellowships", "grants"], "fellowships": ["scholarships", "internships"], "internships": ["fellowships", "workshops"],
    "competitions": ["workshops", "conferences"], "workshops": ["conferences", "competitions"],
}
SPA_MARKERS = ["__NEXT_DATA__", 'id="root"', 'id="app"', "ng-app", "data-reactroot", "nuxt"]
WORDPRESS = r"wp-json|wp-content|wp-includes"

#: Context lengths that token counts are held against, and what stands for a summary in them.
CONTEXTS = [512, 768, 1024, 1536, 2048]
PROXY_TARGET = "MANDATORY\n- (example requirement)\n\nRESTRICTIONS\n- (example restriction)\n\nSUMMARY\nThe opportunity is described above; key eligibility, deadlines, funding and restrictions are listed concisely."
#: What a page needs to count as rendered by its server, and to be worth reading as HTML.
RENDERED_LENGTH, RENDERED_LINKS, PAGE_BYTES = 15_000, 20, 10_000
#: Answers of a host that does not want to be read.
REFUSED_STATUS = [401, 403, 429]
