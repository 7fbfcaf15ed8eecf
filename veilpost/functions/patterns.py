"""Regular expressions in the form the JVM regex engine needs.

The plain patterns (`fixed.PII_PATTERNS`, header patterns) assume that a word character is any
letter, any number or an underscore, that a digit is any decimal digit and that white space
includes the separators U+001C..U+001F.  Java's `\\b \\w \\d \\s` mean something else, with or
without the Unicode flag, so the classes are spelled out here.
"""

WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"
SPACE_CHARS = r"\s\x0B\x1C-\x1F\x85\p{Z}"
SPACE = f"[{SPACE_CHARS}]"
# The same characters as a list, for trimming.
SPACE_LIST = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + (
    "\u2028\u2029\u202f\u205f\u3000"
)
START = f"(?<!{WORD})"  # word boundary in front of a word character
END = f"(?!{WORD})"  # word boundary behind a word character


def _fresh(lead: str, not_after: str = WORD) -> str:
    """`lead` where no `not_after` character stands in front of it.

    The look-behind comes second: tried first, it would run at every character of the text; this
    way it only runs where the lead has matched.
    """
    return f"{lead}(?<!{not_after}{lead})"


# An address may start or end on a character that is not a word character, so both kinds of
# boundary are needed there.  The local part never contains "@": no need to back-track into it.
_EMAIL = (
    rf"(?:{START}[a-zA-Z0-9_]|(?<={WORD})[.+-])[a-zA-Z0-9_.+-]*+@[a-zA-Z0-9-]++\.[a-zA-Z0-9-.]+"
    rf"(?:(?<=[a-zA-Z0-9]){END}|(?<=[.-])(?={WORD}))"
)
_GAP = f"[-{SPACE_CHARS}]?"

PII = {
    "EMAIL": _EMAIL,
    "PHONE": rf"{_fresh('09')}{DIGIT}{{2}}{_GAP}{DIGIT}{{3}}{_GAP}{DIGIT}{{3}}{END}",
    "TW_ID": rf"{_fresh('[A-Z][12]', '[A-Za-z0-9]')}{DIGIT}{{8}}(?![A-Za-z0-9])",
    "CARD": rf"{_fresh(DIGIT + '{4}')}{_GAP}(?:{DIGIT}{{4}}{_GAP}){{2}}{DIGIT}{{4}}{END}",
    "IPV4": rf"{_fresh(DIGIT)}{DIGIT}{{0,2}}\.(?:{DIGIT}{{1,3}}\.){{2}}{DIGIT}{{1,3}}{END}",
    "IPV6": (
        r"[0-9a-fA-F](?=[0-9a-fA-F]{0,3}:)" + rf"(?<!{WORD}[0-9a-fA-F])"
        r"[0-9a-fA-F]{0,3}:(?:[0-9a-fA-F]{1,4}:){1,6}[0-9a-fA-F]{1,4}" + END
    ),
    "URL": rf"https?://[^{SPACE_CHARS})]+",
    "IBAN": rf"{_fresh('[A-Z]{2}' + DIGIT + '{2}')}[A-Z0-9]{{10,30}}{END}",
    "BIC": rf"{_fresh('[A-Z]{6}')}[A-Z0-9]{{2}}(?:[A-Z0-9]{{3}})?{END}",
    "ETH_ADDRESS": rf"{_fresh('0x')}[a-fA-F0-9]{{40}}{END}",
    "BTC_ADDRESS": rf"{_fresh('[13]')}[a-km-zA-HJ-NP-Z1-9]{{25,34}}{END}",
}

# A literal every match must contain.  `contains` on the raw bytes is far cheaper than a regex
# scan, so types with such a literal are only scanned where it occurs.
REQUIRED_LITERAL = {
    "EMAIL": "@",
    "PHONE": "09",
    "IPV4": ".",
    "IPV6": ":",
    "URL": "://",
    "ETH_ADDRESS": "0x",
}

# Types whose matches never hold a line break and whose literal stands on few lines of a mail: only
# those lines are scanned.
LINE_BOUND = ("EMAIL", "IPV6")

# Header patterns, in any letter case.  Letter classes match much faster than the case-insensitive
# flag; U+017F is the one other character that folds to one of these letters.
_FROM = "[Ff][Rr][Oo][Mm]:"
_SUBJECT = "[Ss\u017F][Uu][Bb][Jj][Ee][Cc][Tt]:"
FROM_LINE = rf"{_FROM}{SPACE}*([^\n]+)"
SUBJECT_LINE = rf"{_SUBJECT}{SPACE}*([^\n]+)"
SUBJECT_CUT = rf"{_SUBJECT}[^\n]+\n"
DOMAIN = r"@([\p{L}\p{N}_.-]+)"
TECHNIQUE_ID = rf"T{DIGIT}{{4}}(?:\.{DIGIT}{{3}})?"
LIST_SLICE = r"(?s)\[.*\]"
OBJECT_SLICE = r"(?s)\{.*\}"
