"""Text templates and domain words.

Fixed values: the exact text layouts and default domain words that results must reproduce.  Every operator takes these
as keyword arguments, so other corpora can pass their own words.
"""

# ---------------------------------------------------------------------------------------------------------------------
# Fixed values (text layouts).
FILE_HEADER = "====文件名：{filename}====\n\n"                 # prompt corpus and retrieval record header
CORPUS_ROW = "信息类型: {content_type}\n内容：{content}\n\n"     # prompt corpus row
STORE_HEADER = "\n=== 📄 文件: {filename}===\n\n"               # whole-store text header
STORE_ROW = "信息类型: {filetype}\n\n内容: {content}\n"          # whole-store text row (prints the file type)
RECORD_ROW = "信息类型：{content_type}\n\n内容：{content}\n"     # retrieval record row (full-width colon)
PAGE_BLOCK = "===={url}====\n信息类型：网络数据\n内容：\n{content}\n"
PREVIEW_JOIN = "\n    "
FILE_SPLIT = "====文件名："
FILE_BLOCK_PATTERN = "(?s)^([^\\n]+)====\\n\\n信息类型: ([^\\n]+)\\n内容：(.*)$"
NUMBERED_TAG = "[编号段] "
SHEET_PREFIX = "Sheet: {sheet}\n"
DEFAULT_SHEET = "Sheet1"
QUERY_PREFIX = "为这个句子生成表示以用于检索相关文章："

# Fixed values (domain words, defaults of keyword arguments).
NULL_MARK = "空值"
KEY_COLUMN = "科室名称"
TOTAL_ROW = "合计"
RATE_WORD = "率"
UNIT_PERCENT = "%"
UNIT_COUNT = "人"
EMPTY_SHOWN = "/"
EMPTY_FLOW = "N/A"
PROBLEM_KEY = "存在问题"
SUMMARY_KEY = "总结"
DETAILS_KEY = "具体问题"
CAUSES_KEY = "原因分析"
SUGGESTIONS_KEY = "建议"
ANALYSIS_TITLE = "培训及考核情况分析（鱼骨图）"
CONCLUSION_TITLE = "总结与改进建议"
SUGGESTION_LABEL = "建议内容"
MAIN_PROBLEM_JOIN = "；"
OUTLINE_HEADING = "培训内容包含以下四大核心模块："
OUTLINE_ITEM = "• {value}；"
CHINESE_NUMERALS = ["零", "一", "二", "三", "四", "五", "六", "七", "八", "九", "十"]
NUMBERED_ITEM_PATTERN = "^(\\d+)[、.](.+)"
# ---------------------------------------------------------------------------------------------------------------------


def split_template(template: str, field: str) -> tuple[str, str]:
    """Split a one-field template into the text before and after the field."""
    before, after = template.split("{" + field + "}")
    return before, after
