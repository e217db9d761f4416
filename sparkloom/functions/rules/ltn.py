"""Values of the ltn extractor."""

# Patterns, replacements, selectors and names that the results depend on.

ARTICLE_BAD = [
    r'^首次上稿.*?\d+:\d+$',
    r'^更新時間.*?\d+:\d+$',
]
REPORTERS = [
    r'〔記者(.*?)/.*?〕',
    r'〔記者(.*?)〕',
    r'〔編譯(.*?)/.*?〕',
    r'〔編譯(.*?)〕',
    r'〔(.*?)/.*?報導〕',
    r'\[記者(.*?)/.*?\]',
    r'\[記者(.*?)\]',
    r'\[編譯(.*?)/.*?\]',
    r'\[編譯(.*?)\]',
    r'\[(.*?)/.*?報導\]',
    r'記者(.*?)/.*?',
    r'編譯(.*?)/.*?',
    r'〔(.*?)/.*?〕',
    r'〔(.*?)〕',
    r'(.*?)/.*?',
    r'◎(.*?)\s+',
]
