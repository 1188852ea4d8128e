"""Names and kinds of the loan columns."""

from __future__ import annotations

# The loan extract's column names, with the reading of each.
TEXT = ["id", "grade", "sub_grade", "home_ownership", "verification_status", "loan_status",
        "purpose", "addr_state", "initial_list_status", "application_type"]
NUMBERS = ["loan_amnt", "funded_amnt", "installment", "annual_inc", "dti",
           "delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec", "revol_bal", "total_acc",
           "mort_acc", "pub_rec_bankruptcies", "tot_cur_bal", "total_bal_ex_mort",
           "total_bc_limit", "tot_hi_cred_lim", "avg_cur_bal", "bc_util", "bc_open_to_buy",
           "num_actv_bc_tl", "num_tl_90g_dpd_24m", "mo_sin_old_rev_tl_op",
           "percent_bc_gt_75", "acc_open_past_24mths", "out_prncp", "total_pymnt",
           "total_rec_prncp", "total_rec_int", "total_rec_late_fee", "recoveries",
           "collection_recovery_fee", "last_pymnt_amnt"]
PERCENTS = ["int_rate", "revol_util"]
TERM, EMPLOYMENT, ISSUED, FIRST_CREDIT = "term", "emp_length", "issue_d", "earliest_cr_line"
RAW = [*TEXT, *NUMBERS, *PERCENTS, TERM, EMPLOYMENT, ISSUED, FIRST_CREDIT]

# Status texts that resolve a loan. Any other status means still active.
DEFAULT_STATUSES = ["Charged Off", "Default", "Does not meet credit policy: Status Charged Off"]
PAID_STATUSES = ["Fully Paid"]

# Model inputs. Those not in the extract are derived during cleaning.
_PAYMENTS = {"out_prncp", "total_pymnt", "total_rec_prncp", "total_rec_int",
             "total_rec_late_fee", "recoveries", "collection_recovery_fee", "last_pymnt_amnt"}
RATIOS = ["installment_to_income", "loan_to_income", "revol_bal_to_income",
          "credit_utilization", "bankcard_utilization"]
NUMERIC_FEATURES = [*(n for n in NUMBERS if n not in _PAYMENTS), *PERCENTS,
                    "term_months", "emp_length_years", "credit_history_months", *RATIOS]
CATEGORICAL_FEATURES = ["grade", "sub_grade", "home_ownership", "verification_status",
                        "purpose", "addr_state", "initial_list_status", "application_type"]
FEATURES = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]

# Columns carried beside the features, and features watched for drift.
CARRIED = ["id", "issue_date", "issue_year", "issue_quarter", "vintage", "loan_status",
           "default_flag", "actual_lgd", "ead"]
MONITORED = ["int_rate", "dti", "revol_util", "annual_inc", "loan_to_income",
             "credit_utilization"]
PORTFOLIO = sorted({*CARRIED, *FEATURES})
