"""Values of the setn extractor."""

# Patterns, replacements, selectors and names that the results depend on.

CATEGORIES = {
    0: '熱門',
    2: '財經',
    4: '生活',
    5: '國際',
    6: '政治',
    7: '科技',
    8: '娛樂',
    9: '名家專欄',
    12: '汽車',
    17: '華流',
    34: '運動',
    41: '社會',
    42: '新奇',
    45: '日韓',
    46: '音樂',
    47: '寵物',
    50: '旅遊',
    52: '女孩',
    54: '房產',
    65: '健康',
}
ARTICLE_END = [
    r'※ 免付費防疫專線.*',
]
REPORTERS = [
    r'^記者(.*?)/.*?報導',
    r'^.*?/(.*?)報導',
    r'^影音編輯/(.*?) ',
    r'^助理編輯/(.*?) ',
]
