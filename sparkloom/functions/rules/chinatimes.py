"""Values of the chinatimes extractor."""

# Patterns, replacements, selectors and names that the results depend on.

ARTICLE_BAD = [
    r'文章來源:.*',
    r'----------------.*',
    r'更多內容.*',
    r'全文及圖表請見.*',
    r'圖片來源:.*',
    r'※免付費防疫專線.*',
    r' ★《中時新聞網》提醒您:',
    r' ★中時新聞網提醒您',
]
