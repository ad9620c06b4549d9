"""Language code -> English display name.

A code that is in no table is returned in lower case, as a JVM locale reports
an unknown language.  The lookup is a literal map inside the expression: no
join at any data scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ISO 639-1 two-letter codes with their English (CLDR) names.
ISO_639_1_NAMES = {
    "aa": "Afar", "ab": "Abkhazian", "ae": "Avestan", "af": "Afrikaans", "ak": "Akan",
    "am": "Amharic", "an": "Aragonese", "ar": "Arabic", "as": "Assamese", "av": "Avaric",
    "ay": "Aymara", "az": "Azerbaijani", "ba": "Bashkir", "be": "Belarusian", "bg": "Bulgarian",
    "bh": "Bihari", "bi": "Bislama", "bm": "Bambara", "bn": "Bangla", "bo": "Tibetan",
    "br": "Breton", "bs": "Bosnian", "ca": "Catalan", "ce": "Chechen", "ch": "Chamorro",
    "co": "Corsican", "cr": "Cree", "cs": "Czech", "cu": "Church Slavic", "cv": "Chuvash",
    "cy": "Welsh", "da": "Danish", "de": "German", "dv": "Divehi", "dz": "Dzongkha",
    "ee": "Ewe", "el": "Greek", "en": "English", "eo": "Esperanto", "es": "Spanish",
    "et": "Estonian", "eu": "Basque", "fa": "Persian", "ff": "Fula", "fi": "Finnish",
    "fj": "Fijian", "fo": "Faroese", "fr": "French", "fy": "Western Frisian", "ga": "Irish",
    "gd": "Scottish Gaelic", "gl": "Galician", "gn": "Guarani", "gu": "Gujarati", "gv": "Manx",
    "ha": "Hausa", "he": "Hebrew", "hi": "Hindi", "ho": "Hiri Motu", "hr": "Croatian",
    "ht": "Haitian Creole", "hu": "Hungarian", "hy": "Armenian", "hz": "Herero", "ia": "Interlingua",
    "id": "Indonesian", "ie": "Interlingue", "ig": "Igbo", "ii": "Sichuan Yi", "ik": "Inupiaq",
    "io": "Ido", "is": "Icelandic", "it": "Italian", "iu": "Inuktitut", "ja": "Japanese",
    "jv": "Javanese", "ka": "Georgian", "kg": "Kongo", "ki": "Kikuyu", "kj": "Kuanyama",
    "kk": "Kazakh", "kl": "Kalaallisut", "km": "Khmer", "kn": "Kannada", "ko": "Korean",
    "kr": "Kanuri", "ks": "Kashmiri", "ku": "Kurdish", "kv": "Komi", "kw": "Cornish",
    "ky": "Kyrgyz", "la": "Latin", "lb": "Luxembourgish", "lg": "Ganda", "li": "Limburgish",
    "ln": "Lingala", "lo": "Lao", "lt": "Lithuanian", "lu": "Luba-Katanga", "lv": "Latvian",
    "mg": "Malagasy", "mh": "Marshallese", "mi": "Maori", "mk": "Macedonian", "ml": "Malayalam",
    "mn": "Mongolian", "mr": "Marathi", "ms": "Malay", "mt": "Maltese", "my": "Burmese",
    "na": "Nauru", "nb": "Norwegian Bokmål", "nd": "North Ndebele", "ne": "Nepali", "ng": "Ndonga",
    "nl": "Dutch", "nn": "Norwegian Nynorsk", "no": "Norwegian", "nr": "South Ndebele", "nv": "Navajo",
    "ny": "Nyanja", "oc": "Occitan", "oj": "Ojibwa", "om": "Oromo", "or": "Odia",
    "os": "Ossetic", "pa": "Punjabi", "pi": "Pali", "pl": "Polish", "ps": "Pashto",
    "pt": "Portuguese", "qu": "Quechua", "rm": "Romansh", "rn": "Rundi", "ro": "Romanian",
    "ru": "Russian", "rw": "Kinyarwanda", "sa": "Sanskrit", "sc": "Sardinian", "sd": "Sindhi",
    "se": "Northern Sami", "sg": "Sango", "si": "Sinhala", "sk": "Slovak", "sl": "Slovenian",
    "sm": "Samoan", "sn": "Shona", "so": "Somali", "sq": "Albanian", "sr": "Serbian",
    "ss": "Swati", "st": "Southern Sotho", "su": "Sundanese", "sv": "Swedish", "sw": "Swahili",
    "ta": "Tamil", "te": "Telugu", "tg": "Tajik", "th": "Thai", "ti": "Tigrinya",
    "tk": "Turkmen", "tl": "Tagalog", "tn": "Tswana", "to": "Tongan", "tr": "Turkish",
    "ts": "Tsonga", "tt": "Tatar", "tw": "Twi", "ty": "Tahitian", "ug": "Uyghur",
    "uk": "Ukrainian", "ur": "Urdu", "uz": "Uzbek", "ve": "Venda", "vi": "Vietnamese",
    "vo": "Volapük", "wa": "Walloon", "wo": "Wolof", "xh": "Xhosa", "yi": "Yiddish",
    "yo": "Yoruba", "za": "Zhuang", "zh": "Chinese", "zu": "Zulu",
}

# Three-letter codes that public wiki projects use, and withdrawn two-letter codes, with their
# English (CLDR) names.
FURTHER_NAMES = {
    "ace": "Acehnese", "ang": "Old English", "arc": "Aramaic", "arz": "Egyptian Arabic", "ast": "Asturian",
    "ban": "Balinese", "bar": "Bavarian", "bpy": "Bishnupriya", "bug": "Buginese", "ceb": "Cebuano",
    "ckb": "Central Kurdish", "dsb": "Lower Sorbian", "fil": "Filipino", "frr": "Northern Frisian", "gan": "Gan Chinese",
    "got": "Gothic", "hak": "Hakka Chinese", "haw": "Hawaiian", "hsb": "Upper Sorbian", "ilo": "Iloko",
    "in": "Indonesian", "iw": "Hebrew", "jbo": "Lojban", "ji": "Yiddish", "kab": "Kabyle",
    "lmo": "Lombard", "lzh": "Literary Chinese", "min": "Minangkabau", "myv": "Erzya", "mzn": "Mazanderani",
    "nan": "Min Nan Chinese", "nap": "Neapolitan", "nds": "Low German", "new": "Newari", "pam": "Pampanga",
    "pap": "Papiamento", "pms": "Piedmontese", "pnb": "Western Punjabi", "scn": "Sicilian", "sco": "Scots",
    "sh": "Serbo-Croatian", "szl": "Silesian", "tet": "Tetum", "tpi": "Tok Pisin", "udm": "Udmurt",
    "vec": "Venetian", "war": "Waray", "wuu": "Wu Chinese", "xal": "Kalmyk", "yue": "Cantonese",
}


def language_name_expr(code: Column) -> Column:
    """A literal map lookup, no join at all."""
    flat = []
    for k, v in sorted((ISO_639_1_NAMES | FURTHER_NAMES).items()):
        flat += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*flat), F.lower(code)), F.lower(code))


def with_language_name(df: DataFrame, code_col: str, out_col: str = "language") -> DataFrame:
    """Add the English language name of ``code_col`` (unknown -> the code)."""
    return df.withColumn(out_col, language_name_expr(F.col(code_col)))
