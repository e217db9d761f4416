"""Values of the tvbs extractor."""

# Patterns, replacements, selectors and names that the results depend on.

ARTICLE_STOP = [
    r'因應新冠肺炎疫情，疾管署持續疫情監測與邊境管制措施，',
    r'◎\s*本文摘自',
    r'◎\s*圖片來源',
    r'〈首圖出處',
    r'《TVBS》提醒您',
]
ARTICLE_REMOVED = [
    r'（中央社）',
    r'最HOT話題在這！想跟上時事，快點我加入TVBS新聞LINE好友！',
    r'《TVBS》提醒您：因應新冠肺炎疫情，疾管署持續疫情監測與邊境管制措施，如有疑似症狀，請撥打：1922專線，或 0800-001922。',
    r'(?:實習)?編輯／.*?$',
]
CATEGORIES = {
    'local': '社會',
    'life': '生活',
    'world': '國際',
    'entertainment': '娛樂',
    'china': '中國',
    'politics': '政治',
    'sports': '運動',
    'tech': '科技',
    'focus': '焦點',
    'fun': '新奇',
    'travel': '旅遊',
    'health': '健康',
    'cars': '車',
    'money': '財經',
}
