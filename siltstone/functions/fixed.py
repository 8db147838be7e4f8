"""Word lists, patterns and constants that results depend on.

They are stated as text, in their natural order; the order of categories and of
keywords is part of the results.
"""

from __future__ import annotations

# Keyword patterns, searched without regard to case.
KEYWORDS = (
    "error:", "warning:", "fail(?:ed|ure|ing)?", "broken", "regression", "crash", "segfault", "panic", "oops", "backtrace", "bug",
    r"should\s+(?:use|be|have|call)", r"instead\s+of", "proper(?:ly)?", "correct(?:ly)?", "wrong", "incorrect", "mistake", "typo",
    r"you\s+need\s+to", r"you\s+must", r"do\s+not|don't", r"better\s+(?:to|way|approach)", r"right\s+way",
    r"memory\s+leak", r"use[-.\s]after[-.\s]free", r"double\s+free", r"null[-.\s]pointer", r"buffer[-.\s]overflow", "heap", r"stack\s+overflow",
    "uninitialized", r"out[-.\s]of[-.\s]bounds", r"undefined\s+behavior", r"race[-.\s]condition", "deadlock", "mutex", "lock(?:ing)?", "atomic",
    r"thread[-.\s]safe", "synchroniz", "CFLAGS", "LDFLAGS", "Makefile", "PKG_", "compile", "linker", r"undefined\s+reference",
    r"implicit\s+declaration", "-Werror", "-Wno-", r"out[-.\s]of[-.\s]tree", "kmod", "ubus", "uci", "procd", "netifd", "hotplug", "rpcd", "luci",
    "uhttpd", "libubox", "ustream", "blobmsg", r"init\.d", r"rc\.d", r"\[PATCH\s+v[2-9]", "Fixes:", "inline", "static", "volatile", "const",
    "malloc", "calloc", "realloc", r"free\(", "strlen", "strcpy", "strncpy", "snprintf", "sprintf", "socket", r"bind\(", "ioctl", "netlink",
)

# Categories in the order in which the first match is the primary one.
CATEGORIES = {
    "memory-management": r"malloc|calloc|realloc|free\(|memory\s+leak|use[-.\s]after[-.\s]free|double\s+free|null[-.\s]pointer|buffer[-.\s]overflow|heap|segfault",
    "concurrency": r"thread|mutex|lock(?:ing)?|race[-.\s]condition|deadlock|atomic|synchron",
    "build-system": r"Makefile|PKG_|CONFIG_|compile|linker|CFLAGS|LDFLAGS|kmod|out[-.\s]of[-.\s]tree|-Werror|-Wno-",
    "c-language": r"inline|static\s+.*void|implicit\s+declaration|undefined\s+behavior|cast|const|volatile|gcc|musl",
    "uci-config": r"uci[_\s]|/etc/config|uci\.batch|uci-defaults|option|config\s+\w+",
    "procd-init": r"procd|init\.d|rc\.d|respawn|service|procd_set_param|procd_close_instance",
    "networking": r"netifd|firewall|nftables|iptables|bridge|vlan|interface|socket|netlink|bind\(",
    "ubus-ipc": "ubus|blobmsg|libubox|ustream|uloop",
    "luci-frontend": r"luci|uhttpd|rpcd|cbi|\.js|javascript|rpc",
    "kernel-driver": r"kmod|dts|device[-.\s]tree|kernel|insmod|modprobe|module_init",
    "patch-maintenance": r"bump|upstream|obsolete|remove.*patch|supersed|cherry[-.\s]pick|backport",
    "package-packaging": "ipk|opkg|feed|PKG_SOURCE|PKG_HASH|PKG_VERSION",
}

# Structural signals of a message body.
SIGNALS = {
    "has_compiler_error": r"\w+\.[ch]:\d+:\d+:\s*(?:error|warning):",
    "has_stack_trace": "Call Trace:|BUG:|Oops:|Unable to handle|RIP:|PC is at",
    "has_shell_error": "command not found|No such file|Permission denied|Segmentation fault",
    "has_build_error": r"make\[\d+\]: \*\*\*|ERROR:|FATAL:.*not found|collect2: error",
    "has_code_block": r"(?m)(^[\t ]{4,}\S.*\n){3,}",
    "has_reference_urls": r"https?://(?:bugs\.|github\.com/|git\.|lore\.kernel\.org/|patchwork\.)",
    "has_patch_revision": r"\[PATCH\s+v[2-9]",
}

# What a problem, a correction and a quoted correction look like.
PROBLEM = r"fail|error|crash|regression|broken|bug|doesn't work|not working|segfault|panic|leak|inaccessible|wrong|not building|not compiling|warning|oops|backtrace"
CORRECTION = r"should\s+(?:use|be|have|call)|instead of|proper(?:ly)?|correct(?:ly)?|wrong|incorrect|mistake|you need to|you must|do not|don't|better way|the right way|the fix|this fixes|must be|use .+ not"
QUOTED_CORRECTION = r"should|instead|wrong|incorrect|fix|proper|better|use\s+.+\s+not|the issue|problem here|this\s+(?:is|was)\s+(?:because|due to)|you need|must be|don't do"

# References in texts.
FILE_REFERENCE = r"\b(?:package|target|feeds|toolchain|tools|include|scripts|lib|netifd|procd|luci|ucode)/[^\s:()\[\]{}<>\"']+\.(?:c|h|mk|js|uc|json|sh|patch|lua|py|pl|awk|dts|yaml|yml)\b"
COMMIT = r"\b[a-f0-9]{7,12}\b"

# Senders and subjects that are no discussion.
BOT_SENDER = r"noreply(?:@|\s+at\s+)github\.com|buildbot@|ci@|jenkins@"
VOTE_SUBJECT = r"\[VOTE\]|\b(?:CI|buildbot|patchwork)\b"

# Points of a thread's score, in hundredths.
SCORE = {
    "problem": 30, "correction": 30, "two_authors": 15, "references": 10, "two_messages": 10, "subject_revision": 5, "nack": 5,
    "compiler_error": 25, "stack_trace": 20, "build_error": 20, "code_block": 10, "reference_urls": 5, "body_revision": 10, "lone_bump": -20,
}
PASSING = 30
NO_DATE = "9999-12-31T23:59:59"

# Search hints of the categories that have some.
SEARCH_HINTS = {
    "build-system": ('grep -R "EXTRA_CFLAGS" package/ target/', r'grep -R \"PKG_VERSION|PKG_SOURCE|PKG_HASH\" package/'),
    "procd-init": (r'grep -R \"procd_set_param|procd_open_instance|USE_PROCD\" package/', 'find package -path "*/files/*" -name "*.init"'),
    "uci-config": (r'grep -R \"uci commit|uci set|uci add_list\" package/', 'grep -R "/etc/config" package/'),
    "luci-frontend": (r'grep -R \"require view|require form|rpc.declare\" .', 'find . -path "*luci*" -name "*.js"'),
    "networking": (r'grep -R \"bridge|vlan|firewall|netifd\" package/ target/',),
    "memory-management": (r'grep -R \"malloc|calloc|realloc|free(\" package/ tools/',),
    "patch-maintenance": (r'grep -R \"PKG_SOURCE_VERSION|backport|upstream\" package/',),
}

# Words that a report's signals leave out.
STOP_WORDS = ("the", "and", "for", "with", "that", "this", "from", "into", "have", "will", "when", "then", "not")

# Fields and version of a summary record.
REQUIRED_FIELDS = ("slug", "module", "title", "content_hash", "ai_summary", "ai_when_to_use", "ai_related_topics", "generated_at", "model", "pipeline_version")
RECORD_VERSION = "v12"
UNSAFE_PAYLOAD = r"(?i)<script\b|javascript:|data:text/html|[\x00-\x08\x0b\x0c\x0e-\x1f]"
