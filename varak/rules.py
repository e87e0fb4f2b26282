"""Rules as data: defaults of the operators' parameters."""

from __future__ import annotations

#: Languages whose records stay in the main corpus (fixed values).
TARGET_LANGUAGES = ("tt-Latn-x-zamanalif", "tt-Cyrl", "tt-Latn-x-yanalif", "tt-Arab", "tt-Latn")
SECOND_LANGUAGES = ("crh-Latn", "crh-Cyrl", "crh-Latn-x-yanalif", "crh-Arab")

#: Content types that hold no document, with the rescued and missing ones included (fixed values).
NON_DOCUMENT_TYPES = (
    "application/vnd.android.package-archive", "image/jpeg", "application/x-zip-compressed", "application/zip",
    "application/octet", "application/octet-stream", "text/html", "text/x-python", "application/x-gzip",
    "application/x-rar", "application/x-download", "application/json", "audio/mpeg",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "text/javascript", "application/javascript",
    "application/x-shockwave-flash", "text/css", "application/x-javascript", "image/tiff", "text/x-python-script",
    "audio/mp3", "audio/x-wav", "image/gif", "audio/midi", "image/vnd.adobe.photoshop", "video/3gpp",
    "application/x-7z-compressed", "image/png", "image/x-icon", "application/x-tplink-bin", "video/x-unknown",
    "text/x-Algol68", "application/x-chm", "video/mp4", "image/bmp",
)
NON_DOCUMENT_SUFFIXES = (".eaf", ".musx")
#: ``(type, suffix, type instead)`` of files whose type was detected wrongly (fixed values).
RESCUES = (("application/octet-stream", ".pdf", "application/pdf"), ("text/html", ".txt", "text/plain"), ("text/html", ".doc", "text/plain"))

PDF_TYPES = ("application/pdf", "application/x-pdf")
TEXT_TYPES = (
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "application/epub+zip", "text/markdown",
    "text/plain", "text/html", "text/csv", "text/xml", "application/rtf", "application/msword",
)
EXTENSIONS = {
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": ".docx", "text/plain": ".txt",
    "text/html": ".html", "application/pdf": ".pdf", "application/x-pdf": ".pdf", "image/vnd.djvu": ".djvu",
    "application/epub+zip": ".epub",
}

#: Suffixes that layout programs and archives leave beside texts (fixed values).
LEFTOVERS = (
    ".layout", ".frw", ".txt", ".pac", ".csv", ".xml", ".jpg", ".hdr", ".dat", ".frdat", ".vtt", ".ini", ".aux", ".musx",
    ".mxl", ".zip", ".indd", ".swp", ".tmp", ".DS_Store", ".parquet", ".emf", ".json",
)
#: ``(part of the path, whether the path must begin with it, suffixes)``: files to leave out.
PATH_SKIPS = (("/corpus/архив/", True, (".txt",)), ("/corpus/scan/", False, (".htm", ".epub")), ("/corpus/gazeta/", False, LEFTOVERS))
LIMITED_MARK = "/limited/"
HIDDEN_MARK = "/scan/"
LEGAL_MARKS = (("архив", "закон", ".pdf"),)

#: Starts of a text that begin a new block (fixed values).
BLOCK_STARTS = (
    r"^\s*<\s*/?\s*\w+",
    r"^[*#=-]+\s*\d*\.*\s*[A-ZА-ЯӘӨҮҢҖҺЁ]",
    r"^\d+[.)]\s+[A-ZА-ЯӘӨҮҢҖҺЁ]",
    r"^[IVXLCDM]+\.\s+[A-ZА-ЯӘӨҮҢҖҺЁ]",
)
#: Keys of supplied metadata that are not kept (fixed values).
DROPPED_KEYS = ("available_pages", "doc_card_url", "download_code", "doc_url", "access", "lang")
TOC_MARK = "<!-- mdformat-toc start --no-anchors -->"

#: Sizes of chunks tried one after the other, and the mark of a quota that a smaller chunk may meet (fixed values).
CHUNK_SIZES = (5, 3, 2, 1)
INPUT_QUOTA = "GenerateContentInputTokensPerModelPerMinute"
#: Characters of a text, pages of a layout, and pages at each end of a file, that metadata is drawn from (fixed values).
META_CHARS, LAYOUT_PAGES, META_PAGES = 30_000, 30, 5
