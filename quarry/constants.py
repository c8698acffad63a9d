"""Fixed values that must equal the reference's for equal results.

Stated here once, in their original order, and used as operator defaults.
"""

# Languages ranked and clustered, in list order.
LANGUAGES = ["JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
             "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy"]

# K-means settings (language spread, kernels, convergence eta, iteration cap).
LANG_SPREAD = 50000
KERNELS = 45
ETA = 20.0
MAX_ITERATIONS = 120

# Article line layout (separator, 0-based title start, characters dropped at the end).
ARTICLE_SEPARATOR = "</title><text>"
ARTICLE_TITLE_START = 14
ARTICLE_TAIL = 16

# Activity prefixes of the time-use survey, in precedence order.
PRIMARY_PREFIXES = ["t01", "t03", "t11", "t1801", "t1803"]
WORK_PREFIXES = ["t05", "t1805"]
OTHER_PREFIXES = ["t02", "t04", "t06", "t07", "t08", "t09", "t10", "t12", "t13", "t14", "t15", "t16", "t18"]

# Topic keyword lists and record source order.
GOOGLE_KEYWORDS = ["android", "Android", "galaxy", "Galaxy", "nexus", "Nexus"]
APPLE_KEYWORDS = ["ios", "iOS", "iphone", "iPhone", "ipad", "iPad"]
SITES = ["gizmodo", "TechCrunch", "engadget", "amazondeals", "CNET", "gadgetlab", "mashable"]

# Enumeration bound of the characteristic-function key sets.
KEYSET_BOUND = 1000

# Header and line format of the printed cluster report.
REPORT_HEADER = ["Resulting clusters:",
                 "  Score  Dominant language (%percent)  Questions",
                 "================================================"]
REPORT_LINE = "%7d  %-17s (%-5.1f%%)      %7d"
