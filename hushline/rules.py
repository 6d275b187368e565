"""Redaction rules: word lists, trigger phrases, placeholders and switches.

Rules are resolved once on the driver and enter every plan as literals, so no
task ever reads a configuration file. Missing lists raise before a job starts:
an empty number-word list, for one, would turn the phone pattern into one that
matches anything.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, replace

# --------------------------------------------------------------------------
# Fixed values. They must equal the published configuration for the results to
# agree, so they are listed as they are and in their own order.
# --------------------------------------------------------------------------

INDICATORS: dict[str, tuple[str, ...]] = {
    "reference_number": ("REFERENCE NUMBER", "REFERENCE NO", "REF NUMBER", "REF NO"),
    "bank_digits": (
        "LAST TWO DIGIT", "LAST 2 DIGIT", "FINAL TWO DIGIT", "FINAL 2 DIGIT",
        "ACCOUNT NUMBER",
    ),
    "card_digits": (
        "LAST FOUR DIGIT", "LAST 4 DIGIT", "FINAL FOUR DIGIT", "FINAL 4 DIGIT",
        "CARD NUMBER", "LONG CARD NUMBER", "CREDIT CARD", "DEBIT CARD",
    ),
    "name": ("NAME", "CALLED", "SURNAME", "FIRST NAME", "MAIDEN NAME"),
    "address": ("ADDRESS", "FIRST LINE", "LINE OF", "FLAT", "STREET"),
    "postcode": (
        "POSTCODE", "POST CODE", "POSTAL CODE", "AIR CODE", "AREA CODE", "ZIP CODE",
        "ZIPCODE",
    ),
    "email": ("EMAIL", "E-MAIL", "E MAIL"),
    "password": ("PASSWORD", "PASS WORD", "PASSCODE", "VERIFICATION CODE", "PIN"),
    "phone_number": (
        "MOBILE NUMBER", "PHONE NUMBER", "TELEPHONE NUMBER", "CONTACT NUMBER", "NUMBER",
    ),
}

NUMBER_WORDS = tuple(
    """ZERO ONE TWO THREE FOUR FIVE SIX SEVEN EIGHT NINE TEN ELEVEN TWELVE THIRTEEN
    FOURTEEN FIFTEEN SIXTEEN SEVENTEEN EIGHTEEN NINETEEN TWENTY THIRTY FORTY FIFTY
    SIXTY SEVENTY EIGHTY NINETY HUNDRED OH DOUBLE TRIPLE""".split()
)

CARD_DIGIT_WORDS = tuple("ZERO ONE TWO THREE FOUR FIVE SIX SEVEN EIGHT NINE".split())

FILLER_WORDS = tuple("YES YEAH SO IT ITS IT'S IS THE MY AND A AN".split())

NAME_BOUNDARIES = tuple(
    """I'M IM YOU'RE YOURE HOW CAN WILL AND THE IS ARE FROM AT WHO WHAT WHERE WHEN WHY
    WITH TO FOR IN ON SPEAKING HERE CALLING TODAY HELP ASSIST GOOD GREAT NICE THANK
    THANKS""".split()
)

DENY_WORDS = tuple(
    """I I'M IM I'VE IVE I'LL ILL MY ME YOU YOUR YOU'RE YOURE YOU'LL YOULL YOU'VE YOUVE
    HE HE'S HES SHE SHE'S SHES WE WE'RE WERE WE'VE WEVE WE'LL WELL THEY THEY'RE THEYRE
    THEY'VE THEYVE IT IT'S ITS US
    THE A AN AND BUT OR FOR NOR SO YET AS IF THEN
    TO OF IN ON AT BY WITH FROM ABOUT
    IS ARE WAS WERE BE BEEN BEING AM HAVE HAS HAD DO DOES DID CAN CAN'T CANT COULD
    WOULD SHOULD WILL MUST MAY MIGHT GET GOT GIVE GAVE TAKE NEED WANT
    YES NO YEAH YEP OKAY OK SURE
    PLEASE THANK THANKS SORRY HELLO HI GOODBYE BYE
    WHAT WHERE WHEN WHO WHY HOW WHICH
    HERE THERE THIS THAT THESE THOSE NOW
    NEW ONE JUST WELL BACK ELSE RIGHT NOT COMPLETELY TOTALLY REALLY VERY QUITE ALWAYS
    NEVER MAYBE PERHAPS CERTAINLY DEFINITELY ABSOLUTELY
    UH UM GOODNESS SAKE WAIT LISTEN LOOK
    CALL RING SPEAK TALK TELL SAY SAID HEAR HEARD ASK ASKED
    HELP ACCEPT KNOW TOLD ENGINEER SKY BUSINESS SERVICE CUSTOMER
    TABLET PHONE MOBILE COMPUTER LAPTOP DEVICE
    PASSWORD WRITTEN DOWN SOMEWHERE CHECK LET""".split()
)

NON_NAME_WORDS = tuple(
    """DOING GOING TALKING TRYING WORKING LOOKING CALLING FINE GOOD GREAT OKAY ALRIGHT
    PERFECT LOVELY CORRECT RIGHT WRONG TRUE FALSE CLEAR""".split()
)

TITLES = tuple("MISSUS MISTER MR MRS MS MISS".split())

PLACEHOLDERS: dict[str, str] = {
    "PERSON": "[REDACTED NAME]",
    "AGE": "[REDACTED AGE]",
    "EMAIL_ADDRESS": "[REDACTED EMAIL]",
    "PHONE_NUMBER": "[REDACTED PHONE]",
    "LOCATION": "[REDACTED LOCATION]",
    "ACCOUNT_NUMBER": "[REDACTED ACCOUNT]",
    "CREDIT_CARD": "[REDACTED CARD]",
    "POSTAL_CODE": "[REDACTED POSTCODE]",
    "UK_POSTCODE": "[REDACTED POSTCODE]",
    "ADDRESS": "[REDACTED ADDRESS]",
    "HOUSE_NUMBER": "[REDACTED HOUSE NUMBER]",
    "STREET_NAME": "[REDACTED STREET]",
    "PASSWORD": "[REDACTED PASSWORD]",
    "VERIFICATION_CODE": "[REDACTED CODE]",
    "MONEY": "[REDACTED AMOUNT]",
    "FINANCIAL_AMOUNT": "[REDACTED AMOUNT]",
    "RELATIONSHIP_NAME": "[REDACTED RELATIONSHIP]",
    "STREET_ADDRESS": "[REDACTED STREET ADDRESS]",
    "BANK_ACCOUNT_LAST_DIGITS": "[REDACTED ACCOUNT DIGITS]",
    "REFERENCE_NUMBER": "[REDACTED REFERENCE]",
}

#: Score every spoken-form detector reports.
SPOKEN_SCORE = 0.85
MIN_SCORE = 0.7
MAX_CONVERSATIONAL_RATIO = 0.5

# --------------------------------------------------------------------------
# Our own choices.
# --------------------------------------------------------------------------

#: Label of a merged span when length and score tie; the first one wins.
LABEL_ORDER = (
    "LOCATION", "PASSWORD", "REFERENCE_NUMBER", "PHONE_NUMBER", "CREDIT_CARD",
    "BANK_ACCOUNT_LAST_DIGITS", "EMAIL_ADDRESS", "UK_POSTCODE", "PERSON",
)
UNMAPPED_PLACEHOLDER = "[REDACTED]"

#: Bit position of each kind in the packed context of a turn.
KINDS = tuple(INDICATORS)


class RulesError(ValueError):
    """The rules are incomplete or contradictory."""


def _upper(words) -> tuple[str, ...]:
    return tuple(str(w).upper() for w in words)


@dataclass(frozen=True)
class Rules:
    """Everything the detectors, filters and placeholders depend on."""

    indicators: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(INDICATORS))
    number_words: tuple[str, ...] = NUMBER_WORDS
    card_digit_words: tuple[str, ...] = CARD_DIGIT_WORDS
    filler_words: tuple[str, ...] = FILLER_WORDS
    name_boundaries: tuple[str, ...] = NAME_BOUNDARIES
    deny_words: tuple[str, ...] = DENY_WORDS
    non_name_words: tuple[str, ...] = NON_NAME_WORDS
    titles: tuple[str, ...] = TITLES
    placeholders: dict[str, str] = field(default_factory=lambda: dict(PLACEHOLDERS))
    min_score: float = MIN_SCORE
    max_conversational_ratio: float = MAX_CONVERSATIONAL_RATIO
    check_conversational: bool = True
    #: 'all' applies the deny words to every PERSON hit; 'gazetteer' only to the
    #: name-table and model hits, so a name spelled with A or I survives.
    deny_scope: str = "all"
    #: Let the spoken e-mail pattern take the whole word before the first DOT.
    strict_bounds: bool = False
    #: 'clear' keeps the matched text in the audit, 'hash' its SHA-256, 'keyed' a pseudonym
    #: that nobody without ``audit_key`` can work out, 'none' nothing.
    audit_text: str = "clear"
    audit_key: str = field(default="", repr=False)
    #: Written-form detectors to run next to the spoken ones.
    written: tuple[str, ...] = ("written_email", "written_card", "iban")

    def __post_init__(self):
        for name in ("number_words", "card_digit_words", "filler_words", "name_boundaries",
                     "deny_words", "non_name_words", "titles"):
            words = _upper(getattr(self, name))
            if not words or not all(w.strip() for w in words):
                raise RulesError(f"{name} must not be empty or hold blank words")
            object.__setattr__(self, name, words)
        missing = [k for k in KINDS if not self.indicators.get(k)]
        if missing:
            raise RulesError(f"no trigger phrases for {missing}")
        phrases = {k: _upper(self.indicators[k]) for k in KINDS}
        if any(not p for ps in phrases.values() for p in ps):
            raise RulesError("an empty trigger phrase would fire on every turn")
        object.__setattr__(self, "indicators", phrases)
        if not self.placeholders:
            raise RulesError("placeholders must not be empty")
        if self.deny_scope not in ("all", "gazetteer"):
            raise RulesError(f"unknown deny_scope {self.deny_scope!r}")
        if self.audit_text not in ("clear", "hash", "keyed", "none"):
            raise RulesError(f"unknown audit_text {self.audit_text!r}")
        if self.audit_text == "keyed" and not self.audit_key:
            raise RulesError("audit_text 'keyed' needs an audit_key")

    def __hash__(self):
        return hash(repr(self))

    def with_(self, **changes) -> "Rules":
        """A copy with some fields changed."""
        return replace(self, **changes)

    @classmethod
    def from_files(cls, json_path: str, yaml_path: str | None = None, **overrides) -> "Rules":
        """Read the job's JSON file and, if given, the YAML file with the word lists.

        YAML scalars are read as text, so ON or YES in a word list stay words.
        """
        with open(json_path, encoding="utf-8") as f:
            job = json.load(f)
        values: dict = {}
        if "pii_entities" in job:
            values["placeholders"] = dict(job["pii_entities"])
        if "audit" in job:
            values.update({f"audit_{k}": job["audit"][k] for k in ("text", "key") if k in job["audit"]})
        if "context_indicators" in job:
            given = job["context_indicators"]
            values["indicators"] = {k: given[k] for k in KINDS if k in given}
            if given.get("number_words"):
                values["number_words"] = given["number_words"]
        if yaml_path is not None:
            values.update(_from_yaml(yaml_path))
        values.update(overrides)
        unknown = set(values) - {f.name for f in fields(cls)}
        if unknown:
            raise RulesError(f"unknown rules {sorted(unknown)}")
        return cls(**values)


def _from_yaml(path: str) -> dict:
    try:
        import yaml
    except ImportError as e:
        raise RulesError("reading YAML rules needs PyYAML") from e
    with open(path, encoding="utf-8") as f:
        doc = yaml.load(f, Loader=yaml.BaseLoader) or {}
    values: dict = {}
    for key, name in (("deny_list", "deny_words"), ("number_words", "number_words"),
                      ("filler_words", "filler_words"), ("name_boundaries", "name_boundaries")):
        if not doc.get(key):
            raise RulesError(f"{path}: {key} is missing or empty")
        values[name] = tuple(doc[key])
    person = doc.get("validation", {}).get("person_entity", {})
    if "max_conversational_ratio" in person:
        values["max_conversational_ratio"] = float(person["max_conversational_ratio"])
    if "enabled" in person:
        values["check_conversational"] = person["enabled"].strip().lower() in ("true", "yes", "on", "1")
    score = doc.get("detection_scores", {}).get("min_score_threshold")
    if score is not None:
        values["min_score"] = float(score)
    return values


DEFAULT_RULES = Rules()
