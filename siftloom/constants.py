"""Policy values and lookup tables shared by every job.

Everything in this module is a fixed value: results only match if these lists,
aliases, phrases, patterns and limits are exactly these. They are data, kept as
plain text in their natural order. Callers may pass other values where a
function takes them as a parameter.
"""

# --- fixed values: sizes and rates ------------------------------------------
MIN_TOKENS = 20
MAX_TOKENS = 32768
VALIDATION_FRACTION = 0.02
SEED = 42
NUM_PERMUTATIONS = 128
SIMILARITY_THRESHOLD = 0.90

# --- fixed values: languages accepted in the corpus -------------------------
SUPPORTED_LANGUAGES = (
    "python", "c", "cpp", "csharp", "java", "kotlin", "scala", "groovy",
    "javascript", "typescript", "html", "css", "go", "rust", "zig", "swift",
    "objective-c", "php", "ruby", "perl", "lua", "haskell", "ocaml", "elixir",
    "erlang", "clojure", "fsharp", "r", "julia", "matlab", "sql", "bash",
    "powershell", "dart", "assembly", "fortran", "cobol",
)

# --- fixed values: spellings the language filter folds ----------------------
FILTER_LANGUAGE_ALIASES = {
    "python3": "python", "py": "python", "c++": "cpp", "cc": "cpp",
    "c#": "csharp", "cs": "csharp", "js": "javascript", "ts": "typescript",
    "golang": "go", "sh": "bash", "ps1": "powershell",
}

# --- fixed values: spellings the language detector folds --------------------
DETECTOR_LANGUAGE_ALIASES = {
    "py": "python", "js": "javascript", "ts": "typescript", "cs": "csharp",
    "cpp": "cpp", "c++": "cpp", "cc": "cpp", "cxx": "cpp", "rb": "ruby",
    "sh": "bash", "kts": "kotlin", "swift": "swift", "m": "objective-c",
    "objc": "objective-c", "scala": "scala", "pl": "perl", "lua": "lua",
    "hs": "haskell", "ml": "ocaml", "ex": "elixir", "erl": "erlang",
    "clj": "clojure", "fs": "fsharp", "r": "r", "jl": "julia", "mat": "matlab",
    "dart": "dart", "asm": "assembly", "f": "fortran", "cob": "cobol",
    "groovy": "groovy",
}

# --- fixed values: file extension (after the last dot) to language ----------
EXTENSION_LANGUAGES = {
    "py": "python", "js": "javascript", "ts": "typescript", "tsx": "typescript",
    "jsx": "javascript", "java": "java", "cs": "csharp", "cpp": "cpp",
    "cc": "cpp", "cxx": "cpp", "c": "c", "h": "c", "hpp": "cpp", "go": "go",
    "rs": "rust", "php": "php", "rb": "ruby", "sh": "bash", "bash": "bash",
    "sql": "sql", "html": "html", "css": "css", "kt": "kotlin",
    "swift": "swift", "m": "matlab", "mm": "objective-c", "scala": "scala",
    "pl": "perl", "lua": "lua", "hs": "haskell", "ml": "ocaml", "ex": "elixir",
    "exs": "elixir", "erl": "erlang", "clj": "clojure", "cljs": "clojure",
    "fs": "fsharp", "fsx": "fsharp", "r": "r", "jl": "julia", "dart": "dart",
    "s": "assembly", "asm": "assembly", "f": "fortran", "f90": "fortran",
    "f95": "fortran", "cob": "cobol", "groovy": "groovy",
}

# --- fixed values: shebang fragments, first match wins ----------------------
SHEBANG_LANGUAGES = (
    (("python",), "python"),
    (("node", "javascript"), "javascript"),
    (("bash", "sh"), "bash"),
    (("ruby",), "ruby"),
    (("perl",), "perl"),
)

# --- fixed values: keyword and pattern evidence per language ----------------
# (language, keywords worth 2 each, patterns worth 3 each); ties go to the
# language listed first. Keywords are looked up in lower-cased code.
KEYWORD_WEIGHT = 2
PATTERN_WEIGHT = 3
LANGUAGE_EVIDENCE = (
    ("python",
     ("def", "import", "from", "class", "if __name__", "async", "await"),
     (r"^#!/usr/bin/python", r"^#!/usr/bin/env python")),
    ("javascript",
     ("function", "const", "let", "var", "import", "export", "async"),
     (r"^#!/usr/bin/node", r"^#!/usr/bin/env node")),
    ("typescript",
     ("interface", "type", "enum", "as const", ": string", ": number"),
     (r"\.ts\b", r"typescript")),
    ("java",
     ("public class", "import java", "void main", "package"),
     (r"public\s+class\s+\w+",)),
    ("csharp",
     ("using", "namespace", "public class", "static void Main"),
     (r"using\s+System",)),
    ("cpp",
     ("#include", "std::", "cout", "cin", "vector", "template"),
     (r'#include\s*[<"]',)),
    ("c",
     ("#include <stdio.h>", "void main", "malloc", "printf"),
     (r'#include\s*[<"].*\.h[>"]',)),
    ("go",
     ("package main", "import", "func", "defer", "go "),
     (r"^package main", r'^import\s+[("]')),
    ("rust",
     ("fn", "use", "let", "mut", "impl", "trait", "cargo"),
     (r"fn\s+\w+\s*\(",)),
    ("php",
     ("<?php", "namespace", "use", "function", "$this", "echo"),
     (r"<\?php", r"\$\w+")),
    ("ruby",
     ("def ", "end", "require", "class ", "attr_accessor"),
     (r"^#!/usr/bin/ruby", r"^#!/usr/bin/env ruby")),
    ("bash",
     ("#!/bin/bash", "#!/bin/sh", "echo", "if", "for", "while"),
     (r"^#!/bin/bash", r"^#!/bin/sh")),
    ("sql",
     ("SELECT", "FROM", "WHERE", "INSERT", "UPDATE", "DELETE"),
     (r"^\s*SELECT\s+", r"^\s*INSERT\s+INTO")),
    ("html",
     ("<!DOCTYPE", "<html", "<head", "<body", "<div"),
     (r"<!DOCTYPE", r"<html")),
    ("css",
     (".class", "#id", "@media", "@keyframes", "!important"),
     (r"\.[\w-]+\s*{", r"#[\w-]+\s*{")),
    ("kotlin",
     ("fun", "class", "package", "val", "var", "suspend"),
     (r"^package\s+", r"fun\s+\w+\s*\(")),
    ("swift",
     ("func", "class", "struct", "enum", "protocol", "var", "let"),
     (r"import\s+Foundation",)),
    ("objective-c",
     ("@interface", "@implementation", "@property", "alloc", "init"),
     (r"@interface\s+\w+", r'#import\s+[<"]')),
)
# code must be longer than this before keyword evidence is considered
KEYWORD_MIN_CHARS = 20

# --- fixed values: licenses -------------------------------------------------
ALLOWED_LICENSES = (
    "mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "mpl-2.0",
    "cc-by-4.0",
)
LICENSE_ALIASES = {
    "apache2": "apache-2.0", "apache 2.0": "apache-2.0", "mit license": "mit",
    "bsd3": "bsd-3-clause", "bsd2": "bsd-2-clause",
}
UNSPECIFIED_LICENSES = ("unknown", "none", "", "null")

# --- fixed values: values that count as "not given" before backfill ---------
UNKNOWN_METADATA_VALUES = ("", "unknown", "none", "null", "n/a")

# --- fixed values: quality rules --------------------------------------------
AUTOGENERATED_PHRASES = (
    "generated by", "auto-generated", "do not edit", "automatically generated",
    "@generated",
)
MINIFIED_MAX_LINES = 2
MINIFIED_MIN_CHARS = 2000
MINIFIED_MEAN_LINE = 400
REPETITION_MIN_LINES = 10
REPETITION_MIN_PERCENT = 30
CONTROL_CHARACTERS = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"

# --- fixed values: sample fields --------------------------------------------
DIFFICULTIES = ("easy", "medium", "hard")
UNKNOWN = "unknown"
SOLUTION_KEYS = ("solution", "code", "completion")
SOLVE_INSTRUCTION = "Solve the following programming problem."
SPECIFICATION_INSTRUCTION = (
    "Write a Python function that satisfies the following specification."
)
STARTER_HEADING = "\n\nStarter Code:\n"

# --- fixed values: rejection reasons ----------------------------------------
REASON_EMPTY = "Empty Output"
REASON_BINARY = "Binary Content"
REASON_LANGUAGE = "Language Filter"
REASON_LICENSE = "License Filter"
REASON_QUALITY = "Quality Filter"

# --- fixed values: file suffix to reader, in order of preference ------------
READER_BY_SUFFIX = {"parquet": "parquet", "jsonl": "json", "json": "json", "csv": "csv"}
