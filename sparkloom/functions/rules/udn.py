"""Values of the udn extractor."""

# Patterns, replacements, selectors and names that the results depend on.

ARTICLE_REMOVED = [
    r'（延伸閱讀：.*?）',
    r'...more',
]
