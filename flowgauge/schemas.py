"""Declared schemas. Inputs are read with these and never inferred."""

from __future__ import annotations

# The parquet tables the adapters start from. Timestamps carry no zone.
RAW = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}

# Names a filter value may carry; each becomes one array column of the flattened filter relation.
FILTER_NAMES = (
    "project_url",
    "project_name",
    "deployment_stages",
    "pipeline_status_success",
    "issue_status",
    "include_issue_types",
    "include_issue_status",
    "exclude_issue_status",
    "board_ids",
    "defect_type",
    "assignment_groups",
    "org_name",
    "team_names",
    "pipeline_name",
    "branch_name",
    "pipeline_tags",
    "fix_version",
)

LEVELS = ("level_1", "level_2", "level_3", "level_4", "level_5")

# JSON element types of the release arrays.
RELEASE_JSON = {
    "issues": "issue_key STRING, issue_status STRING, is_done STRING, `current_time` BIGINT",
    "defects": "issue_key STRING, issue_type STRING, isdefect STRING",
    "deployments": "pipeline_id STRING, pipeline_group STRING, pipeline_status STRING, "
    "pipeline_started_at STRING, pipeline_finished_at STRING, ltfc_seconds BIGINT",
    "pull_requests": "merge_request_id STRING, pr_created_datetime STRING, "
    "latest_pr_review_submitted_datetime STRING, pr_merged_datetime STRING",
    "builds": "build_id STRING, build_status STRING, tool_type STRING",
    "gates": "step_id STRING, step_status STRING, tool_type STRING",
    "vulnerabilities": "unique_sha_id STRING, activity_date STRING, last_activity_date STRING",
    "bugs": "`key` STRING, status STRING, creation_date STRING, closed_date STRING",
    "web_vulnerabilities": "IssueId STRING, IsPresent STRING, IsAddressed STRING",
    "tests": "total_tests STRING, failed_tests STRING, skipped_tests STRING, success_tests STRING",
}

# The domain frames that operators take, as the adapters give them. Operators use a part of the columns; more may be present.
DOMAIN = {
    "filter_groups": "filter_group_id STRING, level_1 STRING, level_2 STRING, level_3 STRING, level_4 STRING, "
    "level_5 STRING, active BOOLEAN",
    "filter_values": "id STRING, filter_group_id STRING, tool_type STRING, filter_name STRING, filter_values array<string>, "
    "kpi_uuids array<string>, active BOOLEAN",
    "deploys": "run_id BIGINT, pipeline_source STRING, project_url STRING, project_name STRING, level STRING, "
    "team STRING, pipeline_id STRING, pipeline_name STRING, pipeline_status STRING, step_id STRING, "
    "step_type STRING, step_name STRING, step_conclusion STRING, pipeline_started_at TIMESTAMP_NTZ, "
    "pipeline_commit_sha STRING",
    "deploy_commits": "pipeline_source STRING, to_sha STRING, commit_id STRING, committed_date TIMESTAMP_NTZ, "
    "commit_author STRING, web_url STRING",
    "incidents": "issue_key STRING, issue_project STRING, level STRING, team STRING, itsm_source STRING, "
    "issue_status STRING, issue_created TIMESTAMP_NTZ, issue_resolution_date TIMESTAMP_NTZ, "
    "cfr_total_changes_key STRING, cfr_total_failures_key STRING, mttr_issue_key STRING",
    "issue_history": "issue_key STRING, change_id STRING, itsm_source STRING, issue_type STRING, issue_project STRING, "
    "level STRING, team STRING, issue_status STRING, issue_changelog_itemsfield STRING, "
    "issue_created TIMESTAMP_NTZ, issue_updated TIMESTAMP_NTZ, "
    "board_info array<struct<board_id:bigint,board_name:string,board_type:string>>",
    "issues": "issue_key STRING, itsm_source STRING, customer_id STRING, issue_type STRING, issue_project STRING, "
    "issue_status STRING, issue_priority STRING, issue_created TIMESTAMP_NTZ, "
    "issue_resolution_date TIMESTAMP_NTZ, sprint_id INT, sprint_name STRING, sprint_state STRING, "
    "story_points STRING, board_info array<struct<board_id:bigint,board_name:string,board_type:string>>",
    "boards": "board_id BIGINT, board_name STRING, org_name STRING",
    "commits": "commit_id STRING, commit_date DATE, commit_timestamp TIMESTAMP_NTZ, org_name STRING, "
    "project_name STRING, project_url STRING, user_id INT, copilot_commit_flag STRING, lines_added INT, "
    "lines_removed INT, before_sha STRING, "
    "file_extension array<struct<file_extension:string,lines:struct<additions:int,changes:int,deletions:int>>>, "
    "web_url STRING",
    "commits_prs": "commit_id STRING, commit_timestamp TIMESTAMP_NTZ, pr_id STRING, pr_created_datetime TIMESTAMP_NTZ, "
    "merge_commit_sha STRING, commit_tickets array<string>, ai_tool array<string>, org_name STRING",
    "pull_requests": "merge_request_id STRING, org_name STRING, project_url STRING, pr_state STRING, merge_status BOOLEAN, "
    "pr_created_datetime TIMESTAMP_NTZ, pr_merged_datetime TIMESTAMP_NTZ, "
    "first_pr_review_submitted_datetime TIMESTAMP_NTZ, first_commit_id STRING, "
    "pr_commits array<struct<sha:string,commit_timestamp:string,author_login:string,lines_added:string,lines_removed:string,copilot_commit_flag:string>>",
    "teams": "assignee_login STRING, team_name STRING, org_name STRING, record_update_date DATE",
    "survey": "survey_id STRING, question_id STRING, answer STRING, response_id STRING, "
    "last_submitted_timestamp TIMESTAMP_NTZ, "
    "filters struct<level_1:array<string>,level_2:array<string>,level_3:array<string>,level_4:array<string>,level_5:array<string>>",
    "change_requests": "issue_key STRING, issue_status STRING, issue_started_at TIMESTAMP_NTZ, "
    "issue_resolved_at TIMESTAMP_NTZ, correlation_id STRING, scope STRING, cr_class STRING",
    "assist": "usage_date DATE, used_at TIMESTAMP_NTZ, user_id BIGINT, user_login STRING, org_name STRING, "
    "team_name STRING, tool STRING, ide STRING, language STRING, model STRING, feature STRING, "
    "user_initiated_interaction_count BIGINT, code_generation_activity_count BIGINT, "
    "code_acceptance_activity_count BIGINT, loc_suggested_to_add_sum BIGINT, loc_added_sum BIGINT, "
    "loc_suggested_to_delete_sum BIGINT, loc_deleted_sum BIGINT, used_chat BOOLEAN, used_agent BOOLEAN",
    "seats": "org_name STRING, org_assignee_login STRING, assignee_login STRING, last_activity_at STRING, "
    "created_at DATE",
    "org_map": "org_name STRING, linked_org_name array<string>",
    "sonar_measures": "org_name STRING, project_name STRING, branch STRING, last_analysis_date DATE, "
    "source_record_insert_datetime TIMESTAMP_NTZ, project_bugs_value BIGINT, project_ncloc_value BIGINT, "
    "project_lines_to_cover_value BIGINT, project_uncovered_lines_value BIGINT, "
    "project_reliability_rating_value STRING, project_security_rating_value STRING, "
    "project_sqale_rating_value STRING",
    "sonar_issues": "org_name STRING, project STRING, branch STRING, source_record_insert_datetime TIMESTAMP_NTZ, "
    "type STRING, severity STRING, status STRING",
    "alerts": "alert_id STRING, repository_name STRING, organization STRING, severity STRING, "
    "created_at TIMESTAMP_NTZ, fixed_at TIMESTAMP_NTZ, dismissed_at TIMESTAMP_NTZ",
    "container_scans": "project_name STRING, unique_sha_id STRING, component_sha_id STRING, severity STRING, "
    "activity_date TIMESTAMP_NTZ, cve array<struct<identifier:string,severity:string>>",
    "web_scans": "WebsiteId STRING, WebsiteName STRING, TargetUrl STRING, TargetPath STRING, State STRING, "
    "scan_id BIGINT, InitiatedAt TIMESTAMP_NTZ, InitiatedTime STRING",
    "web_issues": "WebsiteId STRING, Title STRING, Severity STRING, IsPresent BOOLEAN, LastSeenDate STRING",
    "test_runs": "pipeline_id STRING, step_id STRING, run_count INT, pipeline_name STRING, step_name STRING, test_name STRING, repository STRING, "
    "git_url STRING, total_tests INT, passed_tests INT, failed_tests INT, errored_tests INT, "
    "skipped_tests INT, pipeline_tags array<string>, created_at TIMESTAMP_NTZ",
    "secret_scans": "scan_id STRING, repository STRING, flow_name STRING, total_issues INT, activity_date TIMESTAMP_NTZ, "
    "tags array<struct<type:string,value:string>>",
    "secret_issues": "scan_id STRING, severity STRING, reason STRING",
    "test_tickets": "project_name STRING, execution_id STRING, status struct<name:string,final:boolean>, "
    "tickets array<struct<key:string,issue_type:string>>",
    "flow_commits": "ticket_key STRING, commit_id STRING, commit_timestamp TIMESTAMP_NTZ, commit_author STRING, "
    "commit_title STRING, copilot_commit_flag STRING, commit_lines_added BIGINT, "
    "commit_lines_removed BIGINT, commit_lines_modified BIGINT, org_name STRING",
    "flow_prs": "ticket_key STRING, pr_id STRING, pr_created_datetime TIMESTAMP_NTZ, pr_user_name STRING, "
    "pr_title STRING, pr_state STRING, org_name STRING",
    "flow_steps": "ticket_key STRING, pipeline_id STRING, pipeline_started_at TIMESTAMP_NTZ, pipeline_step_name STRING, "
    "pipeline_step_type STRING, pipeline_step_conclusion STRING, org_name STRING",
    "repo_runs": "pipeline_id STRING, project_name STRING, ticket_key STRING, pipeline_started_at TIMESTAMP_NTZ",
    "job_logs": "job STRING, logs STRING, lang STRING",
    "releases": "level_name STRING, level_value STRING, fix_version STRING, issue_project STRING, release_date DATE, "
    "release_status STRING, issues array<string>, defects array<string>, deployments array<string>, "
    "pull_requests array<string>, builds array<string>, gates array<string>, "
    "vulnerabilities array<string>, bugs array<string>, web_vulnerabilities array<string>, "
    "tests array<string>",
    "instances": "instance_id STRING, environment STRING, org_name STRING, max_slots INT, reserved_slots INT",
    "nodes": "instance_id STRING, node_id STRING, total_memory_gb INT, jvm_max_mem_gb INT, cpu_cores INT, "
    "create_time TIMESTAMP_NTZ",
    "activities": "by_whom STRING, event_type STRING, create_time TIMESTAMP_NTZ",
}
