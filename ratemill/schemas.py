"""Declared schemas of the tables, as Spark DDL. Names are the snake_case form of the usual column names."""

SURVEY_RAW = ("diabetes_code double, smoker_code double, activity_any_code double, activity_code double, bmi_implied double, "
              "bmi_code double, age_code double, sex_code double")
EXAM_RAW = "respondent_id double, sex_code double, age double, diabetes_code double, bmi double"
LIFE_TABLE = ("age int, male_death_probability decimal(7,6), male_lives int, male_life_expectancy decimal(5,2), "
              "female_death_probability decimal(7,6), female_lives int, female_life_expectancy decimal(5,2)")
SURVEY_RECORD = ("record_id bigint, source_year int, age_band string, gender string, smoking_status string, diabetes_status string, "
                 "bmi_band string, exercise_freq string, bmi_value decimal(5,2), load_date date, source_file string")
SURVEY_SUMMARY = ("source_year int, age_band string, gender string, smoking_status string, diabetes_status string, bmi_band string, "
                  "exercise_freq string, prevalence_rate decimal(6,4), load_date date, source_file string")
EXAM = ("exam_id bigint, source_cycle string, age_band string, gender string, diabetes_biomarker string, bmi_measured decimal(5,2), "
        "load_date date, source_file string")
MORTALITY = ("mortality_id int, source_year int, age_band string, gender string, condition_flag string, "
             "mortality_rate decimal(8,6), life_expectancy decimal(5,2), load_date date, source_file string")
REFRESH_RUN = ("run_id int, run_type string, started_at date, completed_at date, status string, source_datasets string, "
               "rate_version_id int, notes string")
SOURCE_STATE = ("source_state_id int, source_path string, content_hash string, byte_size bigint, observed_at timestamp, "
                "observed_by_run_id int")
RISK_FACTOR = ("risk_factor_id int, age_band string, gender string, smoking_status string, diabetes_status string, bmi_band string, "
               "mortality_multiplier decimal(6,3), derived_from_run_id int")
RATE_VERSION = "rate_version_id int, effective_date date, expiry_date date, status string, created_by_run_id int"
RATE = "rate_id int, rate_version_id int, risk_factor_id int, product_id int, base_rate decimal(12,2)"
CUSTOMER = "customer_id bigint, birth_date date, gender string, start_date date, end_date date"
PRODUCT = ("product_id int, line_of_business string, series_name string, plan_name string, description string, "
           "annualized_premium decimal(12,2)")
CONTRACT = ("contract_id bigint, contract_number string, activity_status string, modal_premium decimal(12,2), product_id int, "
            "issued_rate_version_id int, effective_date date, expiry_date date, application_id bigint")
CONTRACT_PARTY = "contract_party_id bigint, customer_id bigint, contract_id bigint, role string"
ACCOUNT_MEMBER = "customer_id bigint, account_id bigint"
ACCOUNT_BILLING = "account_id bigint, billing_account_id bigint"
INVOICE = ("invoice_id bigint, billing_account_id bigint, run_date date, due_date date, paid_date date, payment_date date, "
           "premium_subtotal decimal(12,2)")
CLAIM = "claim_id bigint, claim_date date, settlement_date date, contract_id bigint"
PROGRAM = "program_id int, program_name string, partner_gym string, discount_max_pct decimal(5,2)"
ENROLLMENT = "enrollment_id bigint, contract_id bigint, program_id int, enroll_date date, status string"
ACTIVITY = "activity_id bigint, enrollment_id bigint, activity_date date, activity_type string, verified_flag string"
IMPROVEMENT = ("improvement_id bigint, enrollment_id bigint, measure_date date, measure_type string, measure_value decimal(8,2), "
               "baseline_value decimal(8,2), improvement_pct decimal(5,2)")
RENEWAL = ("renewal_id bigint, contract_id bigint, renewal_date date, new_rate_version_id int, wellness_discount_pct decimal(5,2), "
           "final_premium decimal(12,2)")
APPLICATION = ("application_id bigint, customer_id bigint, product_id int, application_date date, applicant_age int, gender string, "
               "smoking_status string, diabetes_status string, bmi_value decimal(5,2), age_band string, bmi_band string, "
               "face_amount decimal(12,2), quoted_rate_version_id int, quoted_premium decimal(12,2), status string")
